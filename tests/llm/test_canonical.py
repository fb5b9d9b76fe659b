import pytest

from sampleloom.llm import canonical as K
from sampleloom.session import ship

TERMS = [
    ("built", "built", None, None, "grouping level"), ("built:film", "film", None, None, "grouping level"), ("built:film:wharf biofilm", "wharf biofilm", "QNT:0000001", "jetty biofilm;WBQ-190", None), ("built:film:harbour biofilm", None, "QNT:0000002;QNT:0000003", None, None),
    ("body:crèche gravel", "crèche gravel", None, "playgroup gravel", None), ("body:kitchen humus", "kitchen humus", None, "scullery humus", None), ("body:flagstone bile", "flagstone bile", None, None, "x"), ("body:harbour bile", "harbour bile", None, None, None), (None, "x", None, None, None),
]
CASES = [
    ("Wharf Biofilm", ["wharf biofilm"]), ("jetty/biofilm", ["wharf biofilm"]), ("biofilm of the harbor", ["harbour biofilm"]), ("wbq 190", ["wharf biofilm"]), ("wbq-191", []), ("see qnt:0000003.", ["harbour biofilm"]), ("built > film > wharf biofilm", ["wharf biofilm"]),
    ("swab of kitchen humus (second visit)", ["kitchen humus"]), ("humus, kitchen", ["kitchen humus"]), ("Kichen humus & wharf biofilm", ["kitchen humus", "wharf biofilm"]), ("creche gravl;FLAGSTONE BILE", ["crèche gravel", "flagstone bile"]), ("K1TCHEN HUMU5", ["kitchen humus"]),
    ("kitchens humus", ["kitchen humus"]), ("flags. bile", ["flagstone bile"]), ("flagstonebile", ["flagstone bile"]), ("kitchen umbrella", []), ("wharf", []), ("film", []), ("n/a", []), ("strain D12", []), ("wharf gravel", []), ("kitchen and humus", []), ("x" * 50_000, []), ("kitchen humus " * 2000, ["kitchen humus"]), ("bile bile", []), (" Wharf　biofilm", ["wharf biofilm"]),
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return K.ontology_lexicon(spark.createDataFrame(TERMS, "term string, display_term string, ontology_link string, synonyms string, term_comment string"))


@pytest.mark.parametrize("value,names", CASES, ids=lambda x: str(x)[:30])
def test_value(lexicon, value, names):
    got = K.Lexicon(lexicon.names).compile().terms(value)
    assert sorted(t.rpartition(":")[2] for t in got) == names


def test_rows(spark, lexicon):
    ship(spark)
    rows = [(i, v, "clash") for i, (v, _) in enumerate(CASES)] * 2 + [(900, None, "c"), (901, " ", "c"), (902, "", "c")]
    got = K.map_to_entries(spark.createDataFrame(rows, "k long, v string, term string"), lexicon, "k", "v").collect()
    assert len(got) == len(set(got)) and {r["k"] for r in got} == set(range(len(CASES)))
    for i, (_, names) in enumerate(CASES):
        assert sorted(r["term"].rpartition(":")[2] for r in got if r["k"] == i) == (names or [""])
    empty = K.Lexicon()
    assert {r["term"] for r in K.map_to_entries(spark.createDataFrame(rows[:3], "k long, v string, term string"), empty, "k", "v").collect()} == {""}


@pytest.mark.parametrize("a,b,ok", [("abc", "abc", True), ("abc", "ab", True), ("abc", "abcd", True), ("abc", "acb", True), ("abc", "xbc", True), ("abc", "xyc", False), ("abc", "a", False), ("", "a", True), ("abcd", "badc", False)])
def test_one_edit(a, b, ok):
    assert K.within_one_edit(a, b) is ok


WORDS = "marsh kettle lantern barley copper willow saddle thistle pebble anchor velvet harvest mortar cinder meadow bramble gravel timber orchard paddle".split()


def _typo(r, w):
    k = r.randrange(1, len(w) - 1)
    return r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("aeiou") + w[k:], w[:k] + w[k + 1] + w[k] + w[k + 2 :], w[:k] + r.choice("qxz") + w[k + 1 :], w + "s", w.replace("e", "3", 1).replace("o", "0", 1)])


def _names(r, n=60):
    """Names of one to five words; no word is a single name and part of another."""
    single, rest = WORDS[:6], WORDS[6:]
    names = {w: f"t:{w}" for w in single}
    while len(names) < n:
        name = " ".join(r.sample(rest, r.randint(2, 5)))
        if not any(set(name.split()) <= set(x.split()) or set(x.split()) <= set(name.split()) for x in names):
            names[name] = f"t:{name}"
    return names


def test_recall_by_length():
    """One slip in one word, any order of words, other words around: at least 0.9 of the names of every length are found, nothing else."""
    import random

    r = random.Random(11)
    names = _names(r)
    lex = K.Lexicon({k: {v} for k, v in names.items()}).compile()
    right, wrong, n = {}, 0, {}
    for name, term in names.items():
        for _ in range(20):
            words = name.split()
            k = r.randrange(len(words))
            words[k] = _typo(r, words[k])
            if r.random() < 0.3:
                r.shuffle(words)
            text = r.choice(["{}", "swab of {} (visit 2)", "D12; {}", "{} near ward"]).format(r.choice([" ", " ", "-", " of the "]).join(words))
            got = lex.terms(text)
            size = len(words)
            n[size] = n.get(size, 0) + 1
            right[size] = right.get(size, 0) + (term in got)
            wrong += len(got - {term})
    assert set(n) == {1, 2, 3, 4, 5} and all(right[k] / n[k] >= 0.9 for k in n), (right, n)
    assert wrong <= 0.02 * sum(n.values()), wrong


@pytest.mark.parametrize("value,name", [("soils", "soil"), ("siol", "soil"), ("fresh water fish pnd", "fresh water fish pond"), ("pond of the old fresh water fish", ""), ("h0sp1ta1 wa5te water 2", "hospital waste water"), ("water from the of a in on at by waste hospital", "hospital waste water"), ("so", "")])
def test_lengths(value, name):
    lex = K.Lexicon({n: {n} for n in ("soil", "fresh water fish pond", "hospital waste water")}).compile()
    assert lex.terms(value) == ({name} if name else set())


def test_blocks(spark):
    """A list that is met block by block gives what one lexicon gives."""
    import random

    ship(spark)
    r = random.Random(2)
    names = _names(r, 40)
    terms = spark.createDataFrame([(v, k, None, None, None) for k, v in names.items()] + TERMS, "term string, display_term string, ontology_link string, synonyms string, term_comment string")
    values = [v for v, _ in CASES]
    for name in names:
        words = name.split()
        k = r.randrange(len(words))
        values += [" ".join([*words[:k], _typo(r, words[k]), *words[k + 1 :]]), f"{name}, {r.choice(list(names))}"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)] * 2 + [(-1, None), (-2, " ")], "k long, v string")
    whole = sorted(map(tuple, K.map_to_list(rows, terms, "k", "v").collect()))
    blocks = sorted(map(tuple, K.map_to_list(rows, terms, "k", "v", block_terms=17).collect()))
    assert blocks == whole and {k for k, _ in whole} == set(range(len(values)))


def test_long_text():
    lex = K.Lexicon({n: {n} for n in ("soil", "fresh water fish pond", "kitchen humus")}).compile()
    assert lex.terms("kitchn humus " * 20_000) == {"kitchen humus"}
    assert lex.terms("kitchn " * 20_000) == set() and lex.terms("water of " * 20_000) == set()
