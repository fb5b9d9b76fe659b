import random

import pytest

from sampleloom.llm import langid as L
from sampleloom.session import ship

# Made-up sentences of four languages; {} takes a code or number.
TEXTS = {
    "en": ["The tubes were filled by the second team because the first one had leaked.", "Nobody could say which of the two boxes {} had been opened first.", "All records were checked twice before they were sent to the archive.", "After {} hours there was still no growth on any of the plates.", "The owner asked us to come back in the spring and bring more bags."],
    "de": ["Die Röhrchen wurden von der zweiten Gruppe gefüllt, weil das erste undicht war.", "Niemand konnte sagen, welche der beiden Schachteln {} zuerst geöffnet wurde.", "Alle Angaben wurden zweimal geprüft, bevor sie ins Archiv gingen.", "Nach {} Stunden zeigte sich auf keiner Platte ein Wachstum.", "Der Besitzer bat uns, im Frühling wiederzukommen und mehr Beutel mitzubringen."],
    "es": ["Los tubos fueron llenados por el segundo equipo porque el primero se había roto.", "Nadie pudo decir cuál de las dos cajas {} se había abierto primero.", "Todos los datos se revisaron dos veces antes de enviarlos al archivo.", "Después de {} horas no se vio crecimiento en ninguna placa.", "El dueño nos pidió que volviéramos en primavera con más bolsas."],
    "pt": ["Os tubos foram enchidos pela segunda equipa porque o primeiro tinha partido.", "Ninguém soube dizer qual das duas caixas {} tinha sido aberta primeiro.", "Todos os dados foram verificados duas vezes antes de irem para o arquivo.", "Depois de {} horas não se viu crescimento em nenhuma placa.", "O dono pediu que voltássemos na primavera com mais sacos."],
}
TAXA = ["Velumia agrestis", "Quorella fulva", "Tarsula minor"]


def _text(r, lang, n=4):
    return " ".join(f"{s.format(r.randrange(500))} {r.choice(TAXA)}." if r.random() < 0.3 else s.format(r.randrange(500)) for s in r.choices(TEXTS[lang], k=n))


def _rows(n, seed, wrong=0.1):
    r = random.Random(seed)
    truth = [r.choice(list(TEXTS)) for _ in range(n)]
    return truth, [(i, _text(r, t), r.choice(list(TEXTS)) if r.random() < wrong else t) for i, t in enumerate(truth)]


@pytest.fixture(scope="module")
def classifier():
    _, rows = _rows(400, 1)
    return L.Classifier(L.fit([(label, text) for _, text, label in rows]))


def test_held_out(classifier):
    truth, rows = _rows(300, 2)
    right = sum([x.lang for x in classifier.segments(text)] == [t] for t, (_, text, _) in zip(truth, rows))
    assert right >= 297


def test_mixed(classifier):
    r = random.Random(3)
    right = 0
    for _ in range(100):
        langs = [r.choice(list(TEXTS))]
        while len(langs) < 3:
            langs.append(r.choice([x for x in TEXTS if x != langs[-1]]))
        parts = [_text(r, x, 2) for x in langs]
        text = "\n\n".join(parts)
        found = classifier.segments(text)
        right += [x.lang for x in found] == langs and all(text[x.start : x.end] in p for x, p in zip(found, parts))
        assert all(0 <= x.confidence <= 1 for x in found)
    assert right >= 95


@pytest.mark.parametrize("text", [None, "", "  \n", "QNT:0000001 | QNT:0000002", "GATTACAGATTACAGATTACA", "12 34.5 67%", "Velumia agrestis; Quorella fulva", "🙂 — …", "zzz qqq"])
def test_no_language(classifier, text):
    assert [x for x in classifier.segments(text) if x.lang] == []


def test_damaged(classifier):
    assert [x.lang for x in classifier.segments("DIE ROHRCHEN WURDEN VON DER ZWEITEN GRUPPE GEFULLT, WEIL DAS ERSTE UNDICHT WAR.")] == ["de"]
    assert [x.lang for x in classifier.segments("The\ntubes\nwere\nfilled\nby the second team &amp; because the first one had leaked.")] == ["en"]
    assert [x.lang for x in classifier.segments(" ".join(TEXTS["es"]).format(1, 2) * 500)] == ["es"]


def test_rows(spark):
    ship(spark)
    truth, rows = _rows(300, 4)
    rows = [(i, t, l if i % 7 else None, "clash") for i, t, l in rows] + [(900, None, "en", "c"), (901, "", "en", "c"), (902, "12 34", "en", "c"), (903, rows[0][1], "zz", "c"), (None, rows[0][1], "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, confidence string").repartition(3)
    got = L.language_segments(df, list(TEXTS)).collect()
    by = {r["doc_id"]: r for r in got}
    for k in (900, 901, 902):
        assert tuple(by[k])[2:] == (0, None, None, 0.0, None, None)
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r["doc_id"]][r["start"] : r["end"]].strip() for r in got if r["lang"])
    assert sum(by[i]["lang"] == t for i, t in enumerate(truth) if i in by) >= 297
    found = L.wrong_or_mixed(spark.createDataFrame(got), list(TEXTS)).collect()
    assert {r["doc_id"] for r in found} == {i for i, r in by.items() if r["lang"] and r["label"] != r["lang"]} and 903 in {r["doc_id"] for r in found}
    assert L.language_segments(df.limit(0), list(TEXTS)).count() == 0
    assert {r["lang"] for r in L.language_segments(df, []).collect()} == {None}


def test_deterministic():
    _, rows = _rows(100, 5)
    pairs = [(label, text) for _, text, label in rows]
    assert L.fit(pairs) == L.fit(pairs[::-1])


def test_places():
    """Sentences are cut out by their places, with character references and without."""
    for text in ("One &amp; two. Three &lt;x&gt; four!\n\nFive; six &#233;t&eacute;. &nope; end", "a. b", "&amp;", "&amp;. &amp;. x", "", ". . .", "A&nbsp;b.\u00a0C &notin; d"):
        for s, a, b in L.spans(text):
            assert L.html.unescape(text[a:b]) == s
        assert [s for s, _, _ in L.spans(text)] == [s for s in L._SENTENCE.split(L.html.unescape(text)) if s]


def test_unclear_run(classifier):
    text = TEXTS["en"][0] + " Zzz qqq. " + TEXTS["en"][2]
    assert [(x.lang, text[x.start : x.end]) for x in classifier.segments(text)] == [("en", text)]
    text = "\n\n".join([" ".join(TEXTS["en"][:3]), "qqq zzz", " ".join(TEXTS["de"][:3])]).replace("{}", "7")
    found = classifier.segments(text)
    assert [x.lang for x in found if x.lang] == ["en", "de"]
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))
