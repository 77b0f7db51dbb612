"""Language by compression: held-out accuracy, and what has no language."""

from pyspark.sql import functions as F

from starloom.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = langid.learned_dictionaries(docs.where(~langid.held_out()))
    assert list(learned)[0] == "en" and set(learned) == {"en", "fr", "de", "es"}
    assert all(len(d) <= 4 * langid.SAMPLE_TEXTS * (langid.SAMPLE_CHARS + 1) for d in learned.values())
    judged = langid.predicted(docs.where(langid.held_out()), learned).join(docs.select("doc_id", "lang"), "doc_id")
    row = judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("right"), F.avg(F.col("rejected").cast("int")).alias("out"), F.min("score"), F.max("score")).first()
    assert row.right >= 0.97 and row.out <= 0.02 and 0 < row[2] <= row[3] <= 1


def test_texts_without_a_language(documents):
    learned = {"aa": b"lorem ipsum dolor sit amet " * 50, "bb": b"quick brown fox jumps over " * 50}
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "quick brown fox"), (None, "lorem ipsum"), (4, "quick brown fox"), (5, "QUICK brown 7 " * 30000)]
    got = langid.predicted(documents(*rows), learned).select("doc_id", "lang_pred", "rejected").collect()
    want = [(1, "und", True), (2, "und", True), (3, "und", True), (4, "bb", False), (4, "bb", False), (5, "bb", False), (None, "aa", False)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert langid.predicted(documents(), learned).collect() == []
    assert [tuple(r)[1:4] for r in langid.predicted(documents((1, "text")), {}).collect()] == [("und", 0.0, 0.0)]


def test_ties_go_to_the_more_frequent_language(documents):
    same = b"alpha beta gamma " * 30
    got = langid.predicted(documents((1, "alpha beta")), {"often": same, "seldom": same}).first()
    assert (got.lang_pred, got.rejected, got.margin) == ("often", True, 0.0)


def test_learning_from_little(spark):
    none = spark.createDataFrame([(1, None, "en"), (2, "...", "fr"), (3, "text", None), (None, "text", "de")], "doc_id long, text string, lang string")
    assert langid.learned_dictionaries(none) == {}
    assert langid.learned_dictionaries(none.limit(0)) == {}


def test_every_language_is_learned_whatever_repeats(spark):
    rows = [(7, f"english words number {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]} here", "en") for i in range(600)]
    rows += [(100 + i, "des mots français", "fr") for i in range(98)] + [(3, "immer dasselbe", "de")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learned_dictionaries(docs)
    assert list(learned) == ["de", "en", "fr"] and learned["de"] == b"immer dasselbe"
    assert learned == langid.learned_dictionaries(docs.repartition(9))
