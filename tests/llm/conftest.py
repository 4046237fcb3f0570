from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def words():
    """Texts of the smallest documents table, in doc_id order."""
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.fixture(scope="session")
def messy_rows(words):
    """(doc_id, text, lang): nulls, empty, blank and long texts, ties, repeated rows, odd characters."""
    texts = [
        None, "", "   \n\t ", "word", "two words", "A b c d", words[0], words[0], words[0] + " tail", words[1].upper(),
        words[2] + "\r\n" + words[2], "x" * 5000, ("long " + words[3] + "\n") * 40, "İstanbul ΣΑΣ ß 日本語のテキスト",
        "mail anna.b@host.example.org, ip 1.2.3.4 and 999.1.1.1, card 4111 1111 1111 1111, +1 (304) 555-3522",
        "aaaa aaaa aaaa aaaa aaaa", "\x00 \x1c nul\x00", "<|endoftext|> and <|startoftext|>", "  two  spaces ", "tab\tand\u00a0nbsp\u2028line",
        *words[5:25],
    ]
    rows = [(i * 3, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[0], (None, words[0], "en"), (None, None, None), (6, "another text under an id that is taken", "en")]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The rows above with further columns, whose names the operators use themselves."""
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(messy_rows, "doc_id bigint, text string, lang string")
    clash = ("fp", "key", "n", "h", "items", "kept", "n_words", "component_id", "stratum", "version", "spans", "score")
    return plain.repartition(3).select(
        "doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"),
        *(F.lit(f"own {c}").alias(c) for c in clash),
    )


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")
