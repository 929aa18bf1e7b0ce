import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, n int"
WORDS = {
    "da": "der blev fundet gamle rester bag køleskabet og virksomheden skal gøre rent før næste besøg ikke også meget hvad bliver pålæg grønt".split(),
    "nb": "det ble funnet gamle rester bak kjøleskapet og virksomheten må gjøre rent før neste besøk ikke også mye hva blir pålegg grønnsaker".split(),
    "sv": "det hittades gamla rester bakom kylskåpet och verksamheten måste städa före nästa besök inte också mycket vad blir pålägg grönsaker".split(),
    "en": "there were old leftovers behind the fridge and the business must clean before the next visit not also much what becomes cold cuts greens".split(),
}


def sentence(lang, r):
    return " ".join(r.choices(WORDS[lang], k=14)).capitalize() + "."


def corpus(n=160, seed=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        label = r.choice([lang] * 8 + [r.choice(list(WORDS)), None])
        rows.append((i, "\n\n".join(sentence(lang, r) for _ in range(3)), label, i))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return L.train(L.labelled_sample(spark.createDataFrame(corpus(), SCHEMA), "text", "lang", "doc_id"))


def test_held_out_sentences(model):
    r = random.Random(99)
    cases = [(x, sentence(x, r)) for x in WORDS for _ in range(50)]
    got, sure = model.decide([L.sentences(s)[0][1] for _, s in cases])
    right = sum(model.langs[g] == x for (x, _), g in zip(cases, got) if g >= 0)
    assert right >= 0.98 * len(cases) and sure.min() > 0 and sure.max() <= 1


def test_rejects_what_is_no_known_language(model):
    got, _ = model.decide(["zxqj wqkx jzzq xkwq vvzx qqjw zzkx wwqx jjxz", "漢字 かな 한글 עברית ωμέγα кириллица ωμέγα кириллица"])
    assert (got == -1).all()


def test_probabilities_sum_to_one():
    pieces = {"a": ["abc abd abe", "bca cab"], "b": ["xyz abc"]}
    m = L.fit(pieces)
    letters = sorted({c for v in pieces.values() for p in v for c in p} | {" "})
    for context in ("", "ab", "zzz", "abc abd ab"):
        for j in range(2):
            # The last stands for every letter unseen.
            total = sum(math.exp(_prefix(m, context + c, j) - _prefix(m, context, j)) for c in [*letters, "Ж"])
            assert abs(total - 1) < 1e-3


def _prefix(m, text, j):
    """Log-probability of a text without an end."""
    if not text:
        return 0.0
    h, place, _ = L._hashes([text])
    total = 0.0
    for i in range(1, len(text) + 1):
        k = min(int(place[i]) + 1, L.ORDER)
        while k:
            at, ok = L._find(m.grams[k], h[k][i : i + 1])
            if ok[0]:
                total += float(m.logp[k][at[0], j])
                break
            if k > 1:
                c, have = L._find(m.contexts[k], h[k - 1][i - 1 : i])
                total += float(m.backoff[k][c[0], j]) if have[0] else 0.0
            else:
                total += float(m.floor[j])
            k -= 1
    assert np.isfinite(total)
    return total


def test_segments_and_paragraphs(spark, model):
    r = random.Random(5)
    da, nb, en = (sentence(x, r) for x in ("da", "nb", "en"))
    rows = [(1, f"{da}\n \t\n{nb} {en}\n\n\n{da}", "da-DK", 0), (2, None, "da", 0), (3, "", None, 0), (4, " \n\n ", "xx", 0), (5, "Nr. 12 (ab)", "da", 0), (6, f"Se også: {en}", "??", 0), (7, da.upper().replace(" ", "\n"), "dansk", 0), (8, (en + " ") * 3000, "English", 0)]
    got = L.identify(spark.createDataFrame(rows + rows[:1], SCHEMA), model=model)
    assert got.columns == ["doc_id", "lang", "n", "segments"]
    segs = {x.doc_id: [(s.para_no, s.seg_no, s.lang) for s in x.segments] for x in got.collect()}
    assert segs[1] == [(0, 0, "da"), (1, 0, "nb"), (1, 1, "en"), (2, 0, "da")]
    assert segs[2] == segs[3] == segs[4] == segs[5] == [] and segs[6] == [(0, 0, "en")] and segs[7] == [(0, 0, "da")] and segs[8] == [(0, 0, "en")]
    paras = L.paragraph_languages(got).withColumn("named", L.named_language(F.col("lang")))
    found = {(x.doc_id, x.para_no, x.para_lang) for x in paras.where("named is null or named <> para_lang").collect()}
    assert found == {(1, 1, "nb"), (1, 1, "en"), (6, 0, "en")}
    docs = {x.doc_id: (x.doc_lang, x.confidence) for x in L.document_languages(got).collect()}
    assert docs[1][0] == "da" and docs[2] == (None, 0.0) and docs[8][0] == "en"


def test_labels(spark):
    cases = {"da": "da", " DA ": "da", "da_DK": "da", "Danish": "da", "no": "nb", "nb-NO": "nb", "Norsk": "nb", "en-GB": "en", "svenska": "sv", "polski": "pl", "deu": "de", "und": None, "??": None, "": None, None: None, "xx": None, "dab": None}
    got = spark.createDataFrame([(k,) for k in cases], "l string").select("l", L.named_language(F.col("l")).alias("x")).collect()
    assert {r.l: r.x for r in got} == cases


def test_nothing_labelled_or_empty(spark):
    rows = [(1, sentence("da", random.Random(1)), None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert L.paragraph_languages(L.identify(df)).count() == 0
    assert L.identify(df.limit(0)).count() == 0


def test_wrong_labels_are_outvoted(model):
    r = random.Random(7)
    by = {x: [sentence(x, r).lower() for _ in range(150)] for x in ("da", "sv")}
    by["sv"] += by["da"][:12]  # labelled wrongly
    m = L.train(by)
    got, _ = m.decide([sentence("da", r).lower().strip(".") for _ in range(60)])
    assert sum(g == m.langs.index("da") for g in got) >= 58
