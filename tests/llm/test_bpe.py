import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampleloom.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "a", "  double  space ", "line\n\n next\tTab", "<|endoftext|> and <|startoftext|>", "it's we've they'll I'd", "Ünïcödé — 漢字 кириллица", "🙂🙂", " nbsp　wide", "x" * 5000, " leading", "trailing ", "1234567890 12,5", "á é", "\r\n\r\n", "tab\t end", "\x1c\x85 odd", "word " * 3000, "GATTACA" * 500]


@pytest.fixture(scope="module")
def brute():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_given(brute):
    assert bpe.encode_texts(pa.array(TEXTS, pa.string()), PATH).to_pylist() == brute(TEXTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=12))
def test_any_text(texts):
    t = tokenizers.Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = t
    t.encode_special_tokens = True
    assert bpe.encode_texts(pa.array(texts, pa.string()), PATH).to_pylist() == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'st1.,é", max_size=40), max_size=12))
def test_white_space(texts):
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    assert bpe.encode_texts(pa.array(texts, pa.string()), PATH).to_pylist() == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_rows(spark, brute):
    from sampleloom.session import ship

    ship(spark)
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "x y", "clash")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = bpe.encode_corpus(df, path=PATH).collect()
    want = dict(zip(range(len(TEXTS)), brute(TEXTS)))
    assert len(got) == len(rows) and all(r["ids"] == want.get(r["doc_id"], brute(["x y"])[0]) for r in got)
    counts = {r["doc_id"]: r["n_tokens"] for r in bpe.count_tokens(df, path=PATH).collect()}
    assert all(counts[i] == len(x) for i, x in want.items())
    assert bpe.encode_corpus(df.limit(0), path=PATH).count() == 0


def test_slices():
    b = pa.record_batch([pa.array(range(5)), pa.array(["aaaa", None, "b" * 50, "", "cc"])], names=["k", "t"])
    assert [x.num_rows for x in bpe.slices(b, 1, 6)] == [2, 1, 2] and sum(x.num_rows for x in bpe.slices(b.slice(0, 0), 1)) == 0
