import pyarrow.parquet as pq
import pytest

from gradeloom.llm import sentences
from gradeloom.llm.sentences import CORPUS_LEAST, Splitter, evidence, judge, judge_caseless


def cut(text, corpus=None):
    return [text[a:b] for a, b in Splitter(corpus).units(text)]


@pytest.fixture
def no_lists(monkeypatch):
    for name in ("TITLES", "REFERENCES", "ENDERS", "NEVER", "_LISTED"):
        monkeypatch.setattr(sentences, name, frozenset())


def learn(texts):
    total = {}
    for t in texts:
        for w, c in evidence(t)[0].items():
            total[w] = [x + y for x, y in zip(total.get(w, [0] * 8), c)]
    out = {w: judge(c, CORPUS_LEAST) or judge_caseless(w, c) for w, c in total.items()}
    return {w: j for w, j in out.items() if j and j != "word"}


def test_a_document_shows_its_own_abbreviation():
    t = "See Acad. Smith and Acad. Jones. The Acad. report is with Acad. Lee. He left."
    assert cut(t) == ["See Acad. Smith and Acad. Jones.", "The Acad. report is with Acad. Lee.", "He left."]
    # one occurrence alone shows nothing
    assert cut("See Acad. Smith.") == ["See Acad.", "Smith."]


def test_the_document_comes_before_corpus_and_lists():
    t = "Der Gen war alt. Das Gen bleibt. Er sah das Gen. Danach ging er."
    assert len(cut(t)) == len(cut(t, {"gen": "title"})) == 4


def test_the_corpus_shows_references_titles_and_short_caseless_tokens(no_lists):
    docs = [f"Das steht in Lfg. {k} und dort." for k in range(9)] + [f"Heute kam Obmn. Karl{'x' * k} her." for k in range(25)] + [f"यह बेद. लेखक{k} हैं।" for k in range(9)]
    known = learn(docs)
    assert known == {"lfg": "ref", "obmn": "title", "बेद": "title"}
    assert len(cut("Es steht in Lfg. 7 da. Gut.", known)) == 2 and len(cut("Obmn. Braun kam. Gut.", known)) == 2
    assert len(cut("Obmn. Braun kam. Gut.")) == 3


def test_words_that_end_sentences_stay_words():
    docs = [f"Kedi {k} eve geldi. Sonra uyudu." for k in range(40)] + ["Sonra kim geldi. Kim bilir, sonra ne oldu."] * 3
    assert learn(docs) == {}


def test_lists_are_a_prior_only(monkeypatch):
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    known = learn(texts)
    whole = [Splitter(known).units(t) for t in texts]
    n = sum(map(len, whole))
    for name in ("TITLES", "REFERENCES", "ENDERS", "NEVER", "_LISTED"):
        monkeypatch.setattr(sentences, name, frozenset())
    lists = sum(len(set(a) - set(Splitter(known).units(t))) for t, a in zip(texts, whole))
    corpus = sum(len(set(a) - set(Splitter({}).units(t))) for t, a in zip(texts, whole))
    assert lists <= 0.002 * n < corpus
