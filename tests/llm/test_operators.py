"""Every operator against a plain, slow version of itself."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import (
    bpe,
    decontam,
    fuzzy_lines,
    graph,
    language,
    near_copies,
    personal,
    quality_rules,
    queries,
    reply_trees,
    token_files,
    url_rules,
)
from larder.llm.common import fresh_path

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def find_roots(nodes, edges):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


# 1 ---------------------------------------------------------------------------------------------


def slow_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    duplicates = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), duplicates, len(again)


def test_quality_counts(messy_rows, words):
    for text in [r[1] for r in messy_rows] + words:
        assert quality_rules.count_text(text) == slow_counts(text)


def test_binomial_tail():
    for n, k, p in [(10, 3, 0.2), (50, 0, 0.05), (200, 7, 0.0125), (5, 5, 0.3), (0, 0, 0.1)]:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want)


def test_quality_guarantee():
    """Over many drawn label sets, a rule whose true rate of false rejection is too high is rarely chosen."""
    rng = np.random.default_rng(0)
    limit = quality_rules.LIMIT / len(quality_rules.CUTOFFS)
    rates = np.linspace(0, 3 * limit, len(quality_rules.CUTOFFS["chars_per_word"]))
    wrong = 0
    for _ in range(400):
        n = 2000
        beyond = (rng.random(n)[:, None] < rates).sum(axis=0).tolist()
        chosen = quality_rules.select_cutoffs({((1, "en"), "chars_per_word"): (n, beyond)})
        cutoff = chosen.get(((1, "en"), "chars_per_word"))
        wrong += cutoff is not None and rates[quality_rules.CUTOFFS["chars_per_word"].index(cutoff)] > limit
    assert wrong <= 400 * quality_rules.ERROR


def test_quality_query(spark, messy, nothing, words):
    got = queries.op1_quality_rules(spark, SF)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    counts, held = {}, defaultdict(list)
    for i, d in docs.items():
        counts[i] = dict(zip(quality_rules.COUNTS, slow_counts(d.text), strict=True))
        c = counts[i]
        c["failed"] = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        c["symbols_per_char"] = c["n_symbols"] / max(1, c["word_chars"])
        c["duplicate_lines_per_line"] = c["n_dup_lines"] / max(1, c["n_lines"])
        c["repeated_words_per_word"] = c["n_repeat_words"] / max(1, c["n_words"])
        c["chars_per_word"] = c["word_chars"] / max(1, c["n_words"])
        if i in good and not c["failed"]:
            held[d.lang].append(c)
    tests = {}
    for lang, some in held.items():
        for rule, cuts in quality_rules.CUTOFFS.items():
            tests[(1, lang), rule] = (len(some), [sum(c[rule] > x for c in some) for x in cuts])
    chosen = quality_rules.select_cutoffs(tests)
    for r in got.collect():
        c = counts[r.doc_id]
        fired = [k for k in quality_rules.CUTOFFS if c[k] > chosen.get(((1, docs[r.doc_id].lang), k), 1e9)]
        assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (c["n_words"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"])
        assert r.base_failed == c["failed"] and r.kept == (not c["failed"] and not fired)
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 1), (3, None, None), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_rules.judge_documents(messy, labels).count() == messy.count()
    assert quality_rules.judge_documents(messy, labels.where("false")).where("size(rules) > 0").count() == 0
    assert quality_rules.judge_documents(nothing, labels).count() == 0
    kept = quality_rules.keep_good(messy, labels)
    assert kept.columns == messy.columns and {r.stratum for r in kept.collect()} == {"own stratum"}


# 2 ---------------------------------------------------------------------------------------------


def test_language_gradients():
    """Backpropagation through time against differences of the loss."""
    net = language.GatedNetwork(["a", "b", "c"], hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    x, g = rng.integers(0, 256, (5, 4)), rng.standard_normal((5, 4, 3))
    for d in "fb":
        states, kept = net._forward(x, d)
        grads = net._backward(x, d, kept, g)
        for name in (f"U{d}", f"E{d}"):
            at = (1, 4) if name[0] == "U" else (x[2, 1], 2)
            net.w[name][at] += 1e-4
            up = (net._forward(x, d)[0].astype(np.float64) * g).sum()
            net.w[name][at] -= 2e-4
            down = (net._forward(x, d)[0].astype(np.float64) * g).sum()
            net.w[name][at] += 1e-4
            assert grads[name][at] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=2e-3)


def test_language_windows_agree_with_training_pass(words):
    net = language.GatedNetwork(["a", "b"])
    x = np.frombuffer(words[0].encode()[: language.WINDOW], np.uint8).astype(np.int64)[:, None]
    logits = net._forward(x, "f")[0] @ net.w["Of"] + net._forward(x[::-1], "b")[0][::-1] @ net.w["Ob"] + net.w["bias"]
    want = language.softmax(logits).sum(axis=0)
    got = net.window_sums(x.T.astype(np.uint8), np.array([len(x)]))
    assert np.allclose(want, got, rtol=1e-3)


def test_language_held_out(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    net = language.learn_languages(messy)
    found = language.identify(messy, net)
    assert found.count() == messy.count()
    assert {r.lang_pred for r in found.where("doc_id IN (0, 3, 6)").collect()} >= {"und"}
    assert language.learn_languages(nothing) is None
    assert {r.lang_pred for r in language.identify(messy, None).collect()} == {"und"}
    assert language.identify(nothing, net).count() == 0


# 3 ---------------------------------------------------------------------------------------------


def slow_spans(text):
    out = []
    for kind, pattern in [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and personal.passes_luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(messy_rows, words):
    rng = random.Random(3)
    odd = ["".join(rng.choice("a.@-+1(2 )%_3-5\n6é") for _ in range(rng.randrange(200))) for _ in range(400)]
    odd += ["a@b.c@d.e", "x@@y.z", "1.2.3.4.5.6.7.8", "0001.2.3.4 256.1.1.1", "4111-1111-1111-1111 4111 1111 1111 1112", "+1 (304) 555-3522.+1"]
    for text in odd + words + [r[1] or "" for r in messy_rows]:
        assert personal.base_spans(text) == slow_spans(text)


def test_crf_paths_and_gradients():
    tagger = personal.Tagger(hidden=3)
    rng = np.random.default_rng(0)
    tagger.w = {k: (v + 0.3 * rng.standard_normal(v.shape)) for k, v in tagger.w.items()}
    n, k = 4, personal.LABELS
    em, y = rng.standard_normal((n, 1, k)), rng.integers(0, k, (n, 1))

    def score(path, e):
        s = tagger.w["first"][path[0]] + tagger.w["last"][path[-1]] + sum(e[t, 0, p] for t, p in enumerate(path))
        return s + sum(tagger.w["T"][a, b] for a, b in itertools.pairwise(path))

    paths = list(itertools.product(range(k), repeat=n))
    assert tuple(tagger._viterbi(em)[:, 0]) == max(paths, key=lambda p: score(p, em))

    def loss(e):
        return np.log(sum(np.exp(score(p, e)) for p in paths)) - score(tuple(y[:, 0]), e)

    g, grads = tagger._crf_gradient(em, y)
    for at in [(0, 0, 1), (2, 0, 3)]:
        step = np.zeros_like(em)
        step[at] = 1e-5
        assert g[at] == pytest.approx((loss(em + step) - loss(em - step)) / 2e-5, abs=1e-4)
    for name, at in [("T", (1, 2)), ("first", (0,)), ("last", (4,))]:
        tagger.w[name][at] += 1e-5
        up = loss(em)
        tagger.w[name][at] -= 2e-5
        down = loss(em)
        tagger.w[name][at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_tagger_gradients():
    tagger = personal.Tagger(hidden=3)
    tagger.w = {k: v.astype(np.float64) for k, v in tagger.w.items()}
    rng = np.random.default_rng(1)
    x, g = rng.integers(0, 129, (5, 4)), rng.standard_normal((5, 4, 3))
    kept = tagger._forward(x, "f")[1]
    grads = tagger._backward(x, "f", kept, g)
    for name, at in (("Uf", (1, 4)), ("Ef", (x[2, 1], 2)), ("Ef", (x[1, 0], 10))):
        tagger.w[name][at] += 1e-4
        up = (tagger._forward(x, "f")[0].astype(np.float64) * g).sum()
        tagger.w[name][at] -= 2e-4
        down = (tagger._forward(x, "f")[0].astype(np.float64) * g).sum()
        tagger.w[name][at] += 1e-4
        assert grads[name][at] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=2e-3)


def test_personal_data(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = personal.learn_spans(docs)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    # windows without a doubt are left out of the search for the best path, with the same labels
    windows = np.stack([np.resize(personal.codes(t), personal.WINDOW) for t in texts[:60]])
    quick, tagger_all = tagger.decode(windows), personal.Tagger()
    tagger_all.w = tagger.w
    x = np.ascontiguousarray(windows.T)
    em = np.empty((*x.shape, personal.LABELS), np.float32)
    em[:] = tagger.w["bias"]
    by_label = em.transpose(0, 2, 1)
    tagger._read(x, "f", by_label, range(len(x)))
    tagger._read(x, "b", by_label, range(len(x) - 1, -1, -1))
    assert (quick == tagger._viterbi(em).T).all()
    # respelled values put into texts without any are found, and nothing else is
    rng = np.random.default_rng(9)
    clean = [t for t in texts if not slow_spans(t)][:200]
    for text, spans in zip(clean, personal.label_texts(tagger, clean), strict=True):
        assert not personal.reconcile(text, [], spans)
    found = 0
    for i, text in enumerate(clean[:120]):
        kind = personal.KINDS[i % 4]
        value = personal.respelled(rng, kind, {"email": "anna.b@mail.example.org"}.get(kind, "+1 (304) 555-3522"))
        at = text.find(" ", len(text) // 2) + 1
        joined = text[:at] + value + " " + text[at:]
        spans = personal.reconcile(joined, personal.base_spans(joined), personal.label_texts(tagger, [joined])[0])
        found += (kind, at, at + len(value)) in [s[:3] for s in spans]
    assert found > 110
    got = personal.find_personal_data(messy, tagger)
    assert got.count() == messy.count() and personal.find_personal_data(nothing, tagger).count() == 0
    assert personal.learn_spans(nothing) is None
    by_text = {r.doc_id: r.spans for r in got.where("doc_id = 42").collect()}
    assert [s.kind for s in by_text[42]] == ["email", "ip", "card", "phone"] and all(s.base for s in by_text[42])
    result = {r.doc_id: r for r in queries.op3_personal_data(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = slow_spans(d.text or "")
        r = result[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in personal.KINDS)
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


# 4 ---------------------------------------------------------------------------------------------


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs):
    """{(doc_id, fingerprint): least doc_id} over links of at most two bits."""
    prints = sorted({f for _, f in pairs})
    edges = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    root = find_roots(prints, edges)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    return {(d, f): least.get(root[f]) for d, f in pairs}


def test_near_copies(spark, messy, messy_rows, nothing):
    want = slow_components([(d, slow_fingerprint(t)) for d, t, _ in messy_rows])
    got = near_copies.near_copies(messy)
    assert got.count() == len(messy_rows)
    assert {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in got.collect()} == want
    assert near_copies.near_copies(nothing).count() == 0
    kept = near_copies.keep_one_of_each(messy)
    assert kept.columns == messy.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = slow_components([(d.doc_id, slow_fingerprint(d.text)) for d in docs])
    got = queries.op4_near_copies(spark, SF).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in got} == want and all(len(r.fingerprint) == 16 for r in got)


def test_near_pairs_of_crowded_variants(spark):
    """Very many fingerprints around a few centres: more than are compared pair by pair."""
    rng = random.Random(1)
    prints = set()
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(220):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
        for _ in range(220):  # many with the same half
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(32), rng.randrange(6))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = near_copies.near_pairs(spark.createDataFrame(signed, "fp bigint")).collect()
    assert all((r.a ^ r.b) % (1 << 64) and ((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in links)
    nodes = [p for (p,) in signed]
    near = [(a, b) for a, b in itertools.combinations(nodes, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    assert find_roots(nodes, near) == find_roots(nodes, [(r.a, r.b) for r in links])


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    edges += [(5, 5), (7, None), (60, 59), (60, 59)]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    whole = [(a, b) for a, b in edges if b is not None and a != b]
    want = find_roots({n for e in whole for n in e}, whole)
    assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 5 ---------------------------------------------------------------------------------------------


def test_reply_trees(spark):
    rng = random.Random(4)
    messages, tree = [], "t"
    for node in range(1, 120):
        messages.append((tree, node, rng.randrange(1, node) if node > 1 else None, float(rng.randrange(10))))
    messages += [("line", i, i - 1, 0.0) for i in range(40)] + [("circle", 1, 2, 1.0), ("circle", 2, 1, 1.0), ("circle", 3, 2, 9.0), (None, 1, None, None)]
    messages.append(messages[0])
    got = reply_trees.chosen_paths(spark.createDataFrame(messages, "tree string, node bigint, parent bigint, score double"), branches=2)
    found = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: r.place):
        found[r.tree, r.branch].append(r.node)
    parent = {m[1]: m[2] for m in messages if m[0] == tree}
    score = {m[1]: m[3] for m in messages if m[0] == tree}
    paths = []
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        paths.append(path[::-1])
    paths.sort(key=lambda p: (-sum(score[n] for n in p) / len(p), -len(p), p[-1]))
    assert found[tree, 1] == paths[0] and found[tree, 2] == paths[1]
    assert found["line", 1] == list(range(40)) and found[None, 1] == [1]
    assert not any(t == "circle" for t, _ in found)


def test_conversations(spark):
    odd = [
        (1, 0, "user", None), (1, 1, "assistant", "\\ <|im_end|> \\<|im_start|> [INST]"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
        (1, None, None, "first"), (2, 5, "assistant", ""), (2, 3, "sys<|im_sep|>tem\n", "<<SYS>>\n\\\\x"), (None, 0, "user", "é🙂"), (None, 1, "assistant", "🙂é"),
    ]
    table = spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string").withColumn("place", F.lit("own"))
    back = {r.tree: r for r in reply_trees.read_back(reply_trees.format_conversations(table)).collect()}
    for conv in (1, 2, None):
        turns = sorted((r for r in odd if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] is not None, r[2], r[3] is not None, r[3]))
        assert back[conv].roles == [r[2] or "" for r in turns] and back[conv].texts == [r[3] or "" for r in turns]
        assert back[conv].learned == [r[3] or "" for r in turns if r[2] == "assistant"]
    assert reply_trees.format_conversations(table.where("false")).count() == 0


def test_conversation_query(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    table += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op5_reply_trees(spark, SF).collect()}
    assert set(got) == {r[0] for r in table}
    for conv, r in got.items():
        turns = sorted(t for t in table if t[0] == conv)
        learned = "".join(t[3] for t in turns if t[2] == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))


# 6 ---------------------------------------------------------------------------------------------


def slow_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :])[0]


def slow_rule(host, path):
    fit = [(s + p, v) for s, p, v in url_rules.SITE_RULES if (host == s or host.endswith("." + s)) and path.startswith(p)]
    return max(fit, key=lambda f: len(f[0])) if fit else (None, None)


URLS = [
    None, "", "no scheme", "http://A.Example.COM", "http://example.com/en/x?y#z", "https://www.example.com/en/", "x://net/es/1", "x://a.net/fr/?q=1&r",
    "http://www.example.com/de/", "http://com/", "http://xcom/", "a://b://c/d", "http://h.org/a\nb?c", "http://spam.bad.org/offer/1?aff=2",
]


def test_mined_rules(spark):
    rng = random.Random(5)
    pages, labels = [], []
    for i in range(600):
        spam = rng.random() < 0.3
        url = f"http://{rng.choice(['x', 'y'])}.{'bad' if spam else 'fine'}.org/{rng.choice(['a', 'b', 'offer'])}/{i}" + ("?aff=1" if rng.random() < 0.5 else "")
        pages.append((i, url))
        bad = spam and ("aff" in url or "offer" in url)
        if i % 3:
            labels.append((i, None if i % 7 == 0 else int(not bad), int(bad)))
    table = spark.createDataFrame(pages, "page_id bigint, url string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    tokens = {u: set(t) for u, t in rows(table.select("url", url_rules.url_tokens(F.col("url"))))}
    of = dict(pages)
    baskets = [(tokens[of[d]], bool(q == 0 or t == 1)) for d, q, t in labels]
    least = max(url_rules.LEAST, math.ceil(url_rules.SUPPORT * len(baskets)))
    counts, bad_counts = Counter(), Counter()
    for has, bad in baskets:
        for n in range(1, len(has) + 1):
            for some in itertools.combinations(sorted(has), n):
                counts[some] += 1
                bad_counts[some] += bad
    want = {s: bad_counts[s] / counts[s] for s in counts if bad_counts[s] >= least and bad_counts[s] / counts[s] >= url_rules.CONFIDENCE}
    fires = {u for u, has in tokens.items() if any(set(s) <= has for s in want)}
    found = url_rules.mine_rules(table, marks)
    got = {tuple(sorted(some)): r.confidence for r in found.collect() for some in itertools.product(*r.tokens)}
    assert got and all(want[s] == pytest.approx(c) for s, c in got.items())
    assert {r.url for r in url_rules.blocked_urls(table, found).collect()} == fires and fires
    judged = {r.page_id: r.verdict for r in url_rules.judge_urls(table, marks).collect()}
    assert judged == {i: "block" if u in fires else "allow" for i, u in pages}


def test_long_addresses_end(spark):
    """Bad pages below one address of 25 parts, whose tokens always occur together."""
    deep = "/".join(f"part{chr(97 + i)}" for i in range(25))
    pages = [(i, f"http://www.a.org/{deep}/{i}" if i < 40 else f"http://www.a.org/x/{i}") for i in range(240)]
    table = spark.createDataFrame([*pages, (900, "http://b.org/parta/1"), (901, "http://b.org/1")], "page_id bigint, url string")
    marks = spark.createDataFrame([(i, int(i >= 40), 0) for i in range(240)], "doc_id bigint, quality int, toxic int")
    judged = {r.page_id: r.verdict for r in url_rules.judge_urls(table, marks).collect()}
    assert judged == {**{i: "block" if i < 40 else "allow" for i, _ in pages}, 900: "block", 901: "allow"}


def test_site_rules(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[4])]
    table = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("host", F.lit("own")).withColumn("has", F.lit(1))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = rows(url_rules.judge_urls(table, none))
    want = []
    for i, u in pages:
        rule, verdict = slow_rule(*slow_parts(u))
        want.append((i, *slow_parts(u), rule, verdict or "allow"))
    assert got == sorted(want, key=str)
    assert url_rules.judge_urls(table.where("false"), none).count() == 0
    got = {r.page_id: (r.host, r.path, r.rule) for r in queries.op6_url_rules(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert got[r.page_id] == (*slow_parts(r.url), slow_rule(*slow_parts(r.url))[0])


# 7 ---------------------------------------------------------------------------------------------


def slow_shingles(line):
    return frozenset(line[i : i + 5] for i in range(max(1, len(line) - 4)))


def slow_dropped(table):
    """{(doc_id, text): places that go} by comparing all lines with all."""
    places = defaultdict(set)
    for d, text in table:
        for at, raw in enumerate((text or "").split("\n") if text is not None else []):
            if raw.strip(" \t\r\n\x0b\x0c"):
                places[raw.strip(" ").lower()].add((float("inf") if d is None else d, at, d, text))
    lines = sorted(places)
    sets = {x: slow_shingles(x) for x in lines}
    edges = []
    for a, b in itertools.combinations(lines, 2):
        common = len(sets[a] & sets[b])
        if common and common / (len(sets[a]) + len(sets[b]) - common) >= fuzzy_lines.SIMILARITY:
            edges.append((a, b))
    root = find_roots(lines, edges)
    groups = defaultdict(set)
    for x in lines:
        groups[root[x]] |= places[x]
    gone = defaultdict(set)
    for some in groups.values():
        first = min(p[:2] for p in some)
        for p in some:
            if p[:2] != first:
                gone[p[2], p[3]].add(p[1])
    return gone


def variants(words, rng, n):
    base = [w for t in words for w in t.split()][:40]
    out = []
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randrange(3)):
            some[rng.randrange(len(some))] = rng.choice(words).split()[0]
        out.append(" ".join(some))
    return out


def test_fuzzy_lines(spark, messy, messy_rows, nothing, words):
    rng = random.Random(6)
    table = [(d, t) for d, t, _ in messy_rows]
    table += [(1000 + i, "\n".join(rng.sample(variants(words, rng, 12), 3))) for i in range(30)]
    df = spark.createDataFrame(table, "doc_id bigint, text string")
    want = slow_dropped(table)
    got = fuzzy_lines.dropped_lines(df)
    assert rows(got, "doc_id", "dropped") == sorted(((d, sorted(want.get((d, t), ()))) for d, t in table), key=str)
    out = rows(fuzzy_lines.without_repeated_lines(df), "doc_id", "text")
    keep = [(d, t if not want.get((d, t)) else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d, t])) for d, t in table]
    assert out == sorted(keep, key=str)
    assert fuzzy_lines.without_repeated_lines(messy).columns == messy.columns
    assert fuzzy_lines.dropped_lines(nothing).count() == 0


def test_crowded_bands(spark, words):
    """One passage in very many versions: more lines share a band than are compared pair by pair."""
    rng = random.Random(7)
    table = [(i, x) for i, x in enumerate(variants(words, rng, 150))]
    want = slow_dropped(table)
    got = rows(fuzzy_lines.dropped_lines(spark.createDataFrame(table, "doc_id bigint, text string")), "doc_id", "dropped")
    assert got == sorted(((d, sorted(want.get((d, t), ()))) for d, t in table), key=str)


# 8 ---------------------------------------------------------------------------------------------


def whole_ids(name, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def odd_texts(words):
    rng = random.Random(8)
    signs = ["a", "word", "Größe", ".", ",", " ", " ", "  ", "\n", "\t", "\r\n", "'s", "?!", "1", "²", "é", "日本", "\u00a0", "_", "\u0301", "<|endoftext|>", "\x00", "...", ", "]
    return words + ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_byte_pieces(words, messy_rows):
    texts = odd_texts(words) + [r[1] for r in messy_rows]
    _, want = whole_ids("byte_bpe_50k.json", texts)
    got = token_files.encode_texts(texts, queries.vocabulary("byte_bpe_50k.json"))
    assert [x.tolist() for x in got] == want


def test_token_files(spark, messy, messy_rows, nothing):
    path = queries.vocabulary("byte_bpe_50k.json")
    folder = fresh_path(spark, "test-tokens")
    token_files.write_token_files(messy, folder, path)
    back = token_files.read_token_files(spark, folder)
    order = sorted(messy_rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    ids = [[*x, token_files.END_ID] for x in whole_ids("byte_bpe_50k.json", [r[1] for r in order])[1]]
    starts = np.append(0, np.cumsum([len(x) for x in ids]))[:-1].tolist()
    got = sorted(back.collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.ids, r.n_tokens, r.start) for r in got] == [(d[0], x, len(x), s) for d, x, s in zip(order, ids, starts, strict=True)]
    sums = {r.start: r.ids_crc32 for r in token_files.checksums(back).collect()}
    assert sums == {s: zlib.crc32(np.array(x, "<u4").tobytes()) for x, s in zip(ids, starts, strict=True)}
    one = token_files.read_token_files(spark, folder, F.col("doc_id") == 42)
    assert [(r.doc_id, r.start) for r in one.collect()] == [(42, s) for d, s in zip(order, starts, strict=True) if d[0] == 42]
    assert "EqualTo(doc_id,42)" in one._jdf.queryExecution().toString()
    empty = fresh_path(spark, "test-tokens")
    token_files.write_token_files(nothing, empty, path)
    assert token_files.read_token_files(spark, empty).count() == 0 if spark.read.format("binaryFile").load(empty).count() else True


def test_token_files_split_by_rows(spark, words):
    """Several files of one range: starts go on from file to file."""
    rows = [(i, words[i % len(words)]) for i in range(300)]
    folder, path = fresh_path(spark, "test-tokens"), queries.vocabulary("byte_bpe_50k.json")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 30)
    try:
        token_files.write_token_files(spark.createDataFrame(rows, "doc_id bigint, text string"), folder, path)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert spark.read.format("binaryFile").option("pathGlobFilter", "*.orc").load(folder).count() >= 10
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.doc_id)
    assert [r.start for r in got] == np.append(0, np.cumsum([r.n_tokens for r in got]))[:-1].tolist()


# 9 ---------------------------------------------------------------------------------------------


def slow_hits(text, items, size=13):
    def words(t):
        return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))]

    have = words(text)
    hit, found = set(), set()
    for item, t in items:
        own = [w for w, _, _ in words(t)]
        for i in range(max(1, len(own) - size + 1) if own else 0):
            window = own[i : i + size]
            for j in range(len(have) - len(window) + 1):
                if [w for w, _, _ in have[j : j + len(window)]] == window:
                    hit |= set(range(j, j + len(window)))
                    found.add(item)
    runs = [j for j in sorted(hit) if j - 1 not in hit]
    ends = [j for j in sorted(hit) if j + 1 not in hit]
    return len(have), len(hit), sorted(str(x) for x in found if x is not None), [(have[a][1], have[b][2]) for a, b in zip(runs, ends, strict=True)]


def test_decontamination(spark, messy, messy_rows, nothing):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op9_decontamination(spark, SF).collect()}
    hits = 0
    for d, text in texts:
        n, hit, found, _ = slow_hits(text, items) if len(text) < 6000 or got[d].n_hit else (got[d].n_words, 0, [], [])
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), sha(",".join(found)))
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        hits += hit > 0
    assert hits
    own = [(10, "Two words"), (9, "word"), (2, None), (3, " .,"), (None, "b C"), (10, "nbsp line"), (4, messy_rows[6][1]), (4, messy_rows[6][1])]
    table = spark.createDataFrame(own, "item_id bigint, text string").withColumn("spans", F.lit(1))
    for block in (decontam.BLOCK_WORDS, 3):
        out = decontam.find_contamination(messy, table, block_words=block, prefix="x_").collect()
        assert sorted((r.doc_id, r.text, r.n_words) for r in out if r.doc_id and r.text) == sorted((d, t, "own n_words") for d, t, _ in messy_rows if d and t)
        for r in out:
            want = slow_hits(r.text, own)
            assert (r.x_n_words, r.x_n_hit, r.x_items, [(s.start, s.end) for s in r.x_spans]) == want
    assert decontam.find_contamination(nothing, table).count() == 0
    assert decontam.find_contamination(messy, table.where("false")).where("contaminated OR n_hit > 0").count() == 0


# 10 --------------------------------------------------------------------------------------------


def test_speculative_merges(words, messy_rows):
    path = queries.vocabulary("word_bpe_49k.json")
    texts = odd_texts(words) + [r[1] for r in messy_rows] + ["a" * n for n in range(1, 70)] + ["abab" * 30, "thethethe" * 12]
    tokenizer, want = whole_ids("word_bpe_49k.json", texts)
    got = bpe.encode_texts(texts, path)
    assert [x.tolist() for x in got] == want
    for ids in want:
        assert bpe.decode_ids(np.array(ids, "<u4"), path).decode() == tokenizer.decode(ids, skip_special_tokens=False)
    one, rng = bpe.encoder(path), random.Random(9)
    some = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    assert one.encode_words(some) == [one.merge(w) for w in some]


def test_bpe_query(spark, messy, messy_rows, nothing):
    path = queries.vocabulary("word_bpe_49k.json")
    tokenizer, want = whole_ids("word_bpe_49k.json", [r[1] for r in messy_rows])
    lines = [
        (r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tokenizer.decode(ids, skip_special_tokens=False)))
        for r, ids in zip(messy_rows, want, strict=True)
    ]
    assert rows(bpe.digests(bpe.decode(bpe.encode(messy, path), path))) == sorted(lines, key=str)
    assert bpe.encode(nothing, path).count() == 0
