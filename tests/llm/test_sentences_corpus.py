from gradeloom.llm import sentences
from gradeloom.llm.sentences import sentence_units

WORDS = ("einschl", "entspr", "zzgl")


def units(spark):
    texts = [f"Die Kosten {w}. der Steuer {k} steigen." for w in WORDS for k in range(6)] + [f"Preis {w}. 19 Prozent Steuer." for w in WORDS]
    texts += [None, "", texts[-1]]
    df = spark.createDataFrame([(k % 20, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    return sorted(tuple(r) for r in sentence_units(df).collect()), len([t for t in texts if t])


def test_long_abbreviations_have_corpus_evidence(spark):
    got, n = units(spark)
    assert len(got) == n  # each text is one unit


def test_evidence_beyond_the_broadcast_bound(spark, monkeypatch):
    whole, _ = units(spark)
    monkeypatch.setattr(sentences, "MAX_TYPES", 1)
    assert units(spark)[0] == whole
