"""op1 with more labelled languages than 64: each is tested by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.llm import quality_rules


def test_each_language_is_a_stratum(spark):
    sizes = {"big": 2000, **{f"l{i:02}": 300 for i in range(63)}, **{f"m{i}": 200 for i in range(7)}, "odd": 3}
    rows = [(lang, i, lang in ("l00", "odd")) for lang, n in sizes.items() for i in range(n)] + [(None, i, False) for i in range(2000)]
    rows += [("big", -1, True), (None, -1, True), ("unlabelled", -1, True)]
    rows = [(d, lang, i >= 0, *((100, 2500, 2000, 10, 10, 50) if strange else (100, 500, 0, 10, 0, 0))) for d, (lang, i, strange) in enumerate(rows)]
    counted = spark.createDataFrame(rows, "doc_id bigint, stratum string, labelled boolean, " + ", ".join(f"{c} bigint" for c in quality_rules.COUNTS))
    labels = counted.where("labelled").select("doc_id", F.lit(1).alias("quality"))
    cutoffs = quality_rules.calibrate(counted, labels)
    assert {s for s, _ in cutoffs} == {(1, "big"), (0, None)}
    fired = counted.select("stratum", "labelled", quality_rules.rejected_by(cutoffs).alias("rules")).where("size(rules) > 0").collect()
    assert sorted(((r.stratum, r.labelled, len(r.rules)) for r in fired), key=str) == [("big", False, 4), (None, False, 4)]
    assert counted.select(quality_rules.rejected_by({}).alias("rules")).where("size(rules) > 0").count() == 0


def test_seventy_languages_can_be_predicted(spark):
    """op2: each of 70 made-up languages has letters of its own; one id repeats very often."""
    import random

    from larder.llm import language

    rnd = random.Random(7)
    letters = [chr(0x4E00 + 3 * i) for i in range(70)]
    text = lambda c: " ".join(c * rnd.randint(1, 4) for _ in range(30))
    rows = [(70 * k + i, text(letters[i]), f"l{i:02}") for k in range(12) for i in range(70)]
    rows += [(5000, text("a"), "hot")] * 3000 + [(None, text("b"), "none")] * 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language.learn_languages(docs)
    assert len(network.languages) == 72
    found = language.identify(docs, network).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    right = found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9, right
