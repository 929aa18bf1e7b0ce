"""Missing or wrong document language labels (problem 9).

Per language an interpolated Kneser-Ney model over characters (order 5). The models of all languages
share sorted arrays of n-gram hashes, one an order, with a row of log-probabilities by language: a text is
scored against every language with one binary search a character; unseen n-grams go down by
the stored back-off weights. Each sentence gets the language of the lowest cross-entropy per character, or
none where even that is above what held-out sentences of the language reach (calibrated rejection).
The confidence is the posterior of the language under a temperature fitted to the same held-out sentences.

Fitting. Labels are known to be wrong at times, so the models are fitted in rounds that drop or
move sentences whose label the other sentences contradict (see ``train``). The sample is bounded:
``SAMPLE_DOCS`` labelled documents a language, chosen by a hash of the id. Everything else is applied to every
document and the whole of its text.

Paragraphs lie between blank lines (white space only) and are numbered from 0; sentences end with a
letter and . ! or ? before white space. What comes before a colon, and what stands in brackets or angled
quotes, is a piece of its own, of whatever length, so that a foreign insertion is not taken for the sentence
around it. Every piece is scored. One whose own posterior is below ``CLEAR`` (names, short notices)
is judged together with the nearest clear piece of its paragraph and has the confidence that follows;
the lengths of texts decide nothing. All pieces are in the segments; letters of a paragraph's
sentences are those outside brackets and quotes. Only pieces without a clear neighbour that are too
short for one n-gram of the model are no segment.

Edge cases: null, empty and blank texts have no paragraphs and no language; labels that name no known
language are null; a text is judged by itself, so repeated rows agree; without any labelled row no
language is known and nothing is found.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 5
SAMPLE_DOCS = 400
LEAST_LETTERS = 50
NEIGHBOUR = 1e4  # how many times likelier than another the language of the nearest clear piece is
CLEAR = 1 - 1 / NEIGHBOUR  # posterior from which a piece is judged by itself
KNOWN_LIMIT = 400_000  # judged pieces one worker remembers; beyond it the memory is emptied
SOME_LEAD, CLEAR_LEAD = 2.0, 12.0  # nats by which the best language must lead for a sentence to be fitted on: if it is the label, or else
CHUNK = 400_000  # characters scored at a time

# Codes and names of the languages.
NAMES = {
    "da": "da", "dan": "da", "dansk": "da", "danish": "da", "dänisch": "da", "danska": "da", "duński": "da",
    "en": "en", "eng": "en", "english": "en", "engelsk": "en", "engelska": "en", "englisch": "en", "angielski": "en",
    "de": "de", "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "tysk": "de", "tyska": "de", "niemiecki": "de",
    "sv": "sv", "swe": "sv", "swedish": "sv", "svensk": "sv", "svenska": "sv", "schwedisch": "sv", "szwedzki": "sv",
    "nb": "nb", "nob": "nb", "no": "nb", "nor": "nb", "norsk": "nb", "norwegian": "nb", "bokmål": "nb", "bokmal": "nb", "norska": "nb", "norwegisch": "nb", "norweski": "nb",
    "pl": "pl", "pol": "pl", "polish": "pl", "polski": "pl", "polsk": "pl", "polska": "pl", "polnisch": "pl",
}


def named_language(label: Column) -> Column:
    """The language a label names: its code, a name, or a code with a region; else null."""
    s = F.lower(F.trim(F.regexp_replace(label, r"[\s\p{Z}]+", " ")))
    table = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, s), F.try_element_at(table, F.regexp_extract(s, r"^(\p{L}+)(?:[-_ (].*)?$", 1)))


_BLANK_LINE = re.compile(r"\n\s*\n")
_ASIDES = re.compile(r"\([^()]*\)|»[^«»]*«|\[[^\[\]]*\]")
_NOT_LETTER = re.compile(r"[^\w]+|[\d_]+")
_END = "\u0000"


def pieces(text: str | None) -> list[tuple[int, str, bool]]:
    """(paragraph, piece, whether it is in brackets or quotes); those come after the others of their paragraph."""
    out: list[tuple[int, str, bool]] = []
    no = -1
    for para in _BLANK_LINE.split(unicodedata.normalize("NFC", text or "").replace(_END, " ")):
        flat = " ".join(para.split())
        if not flat:
            continue
        no += 1
        asides = [x[1:-1] for x in _ASIDES.findall(flat)] if "(" in flat or "»" in flat or "[" in flat else []
        if asides:
            flat = " ".join(_ASIDES.sub(" ", flat).split())
        for group, aside in [(flat, False), *((x, True) for x in asides)]:
            held = ""
            for x in group.replace(". ", "." + _END).replace("! ", "!" + _END).replace("? ", "?" + _END).split(_END):
                held = f"{held} {x}" if held else x
                if held[-2:-1].isalpha():
                    out += [(no, y, aside) for y in held.split(": ")]
                    held = ""
            if held:
                out += [(no, y, aside) for y in held.split(": ")]
    return out


def plain(piece: str) -> str:
    """Letters and blanks of a piece, in lower case."""
    return " ".join(_NOT_LETTER.sub(" ", piece.lower()).split())


def sentences(text: str | None) -> list[tuple[int, str, int]]:
    """(paragraph, letters and blanks in lower case, number of letters) of each piece with letters outside brackets and quotes."""
    found = ((no, plain(x)) for no, x, aside in pieces(text) if not aside)
    return [(no, x, len(x) - x.count(" ")) for no, x in found if x]


def _hashes(pieces: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """H[k][i]: hash of the k characters that end at i (H[0] is zero); place within the piece; piece number."""
    flat = "".join(f"\u0002{p} " for p in pieces)
    codes = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(p) + 2 for p in pieces), dtype=np.int64, count=len(pieces))
    owner = np.repeat(np.arange(len(pieces)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    with np.errstate(over="ignore"):
        one = (codes + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        one ^= one >> np.uint64(29)
        one *= np.uint64(0x94D049BB133111EB)
        h = [np.zeros(len(codes), np.uint64), one]
        for _ in range(ORDER - 1):
            prev = np.concatenate([[np.uint64(0)], h[-1][:-1]])
            h.append(one + prev * np.uint64(0xD6E8FEB86659FD93))
    return h, place, owner


@dataclass
class Model:
    """Sorted hash arrays: by order k the n-grams with log-probabilities, and the contexts with log back-off weights, a column a language."""

    langs: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: np.ndarray
    reject: np.ndarray  # by language: cross-entropy that a long piece may have, and what the root of a piece's length divides
    temperature: float = 1.0

    def cross_entropy(self, pieces: list[str]) -> np.ndarray:
        """Nats per character, a row a piece and a column a language."""
        out = np.zeros((len(pieces), len(self.langs)))
        at, size = 0, 0
        for i, p in enumerate(pieces):
            size += len(p) + 2
            if size >= CHUNK or i == len(pieces) - 1:
                out[at : i + 1] = self._score(pieces[at : i + 1])
                at, size = i + 1, 0
        return out

    def _score(self, pieces: list[str]) -> np.ndarray:
        h, place, owner = _hashes(pieces)
        total = np.zeros((len(place), len(self.langs)), np.float32)
        order = np.minimum(place + 1, ORDER)
        order[place == 0] = 0
        active = np.flatnonzero(order)
        for k in range(ORDER, 0, -1):
            mine = active[order[active] == k]
            at, found = _find(self.grams[k], h[k][mine])
            total[mine[found]] += self.logp[k][at[found]]
            missed = mine[~found]
            order[mine[found]] = 0
            if k > 1 and len(missed):
                c, have = _find(self.contexts[k], h[k - 1][missed - 1])
                total[missed[have]] += self.backoff[k][c[have]]
                order[missed] = k - 1
            elif len(missed):
                total[missed] += self.floor
        sums = np.stack([np.bincount(owner, weights=total[:, j], minlength=len(pieces)) for j in range(len(self.langs))], axis=1)
        return -sums / np.maximum(np.bincount(owner, minlength=len(pieces)) - 1, 1)[:, None]

    def posteriors(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(posterior by language, whether the piece is rejected) of each piece."""
        if not pieces or not self.langs:
            return np.zeros((len(pieces), len(self.langs))), np.ones(len(pieces), bool)
        ce = self.cross_entropy(pieces)
        best = ce.argmin(axis=1)
        lengths = np.fromiter(map(len, pieces), dtype=float, count=len(pieces))
        z = np.exp(-(ce - ce.min(axis=1, keepdims=True)) * (lengths * self.temperature)[:, None])
        allowed = np.maximum(self.reject[0, best], self.reject[1, best] + self.reject[2, best] / np.sqrt(np.maximum(lengths, 1)))
        return z / z.sum(axis=1, keepdims=True), ce[np.arange(len(best)), best] > allowed

    def decide(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(column of the language or -1, confidence) of each piece by itself."""
        p, rejected = self.posteriors(pieces)
        if not pieces or not self.langs:
            return np.full(len(pieces), -1), np.zeros(len(pieces))
        return np.where(rejected, -1, p.argmax(axis=1)), p.max(axis=1)


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def fit(samples: dict[str, list[str]]) -> Model:
    """Interpolated Kneser-Ney models of the languages that have sentences."""
    langs = [x for x in sorted(samples) if samples[x]]
    if not langs:
        return Model([], [], [], [], [], np.empty(0, np.float32), np.empty((3, 0)))
    counts: list[list] = []  # by language and order: grams, counts, contexts, suffixes
    for lang in langs:
        h, place, _ = _hashes(samples[lang])
        per: list = [None]
        for k in range(1, ORDER + 1):
            ok = place >= max(k - 1, 1)
            index = np.flatnonzero(ok)
            if k < ORDER:  # continuation counts: distinct longer n-grams that end so; at the begin of a piece, plain counts
                longer = np.flatnonzero(place >= k)
                _, one = np.unique(h[k + 1][longer], return_index=True)
                index = np.concatenate([longer[one], np.flatnonzero((place == k - 1) & (place > 0))])
            grams, one, n = np.unique(h[k][index], return_index=True, return_counts=True)
            i = index[one]
            per.append((grams, n.astype(float), h[k - 1][i - 1] if k > 1 else np.zeros(len(i), np.uint64), h[k - 1][i]))
        counts.append(per)
    grams, logp, contexts, backoff = [np.empty(0, np.uint64)], [None], [np.empty(0, np.uint64)], [None]
    lower = None
    floor = np.zeros(len(langs), np.float32)
    for k in range(1, ORDER + 1):
        every = np.concatenate([c[k][0] for c in counts])
        keys, one = np.unique(every, return_index=True)
        ctx = np.concatenate([c[k][2] for c in counts])[one]
        suffix = np.concatenate([c[k][3] for c in counts])[one]
        ctx_keys = np.unique(ctx)
        p, w = np.zeros((len(keys), len(langs))), np.ones((len(ctx_keys), len(langs)))
        at_ctx = np.searchsorted(ctx_keys, ctx)
        for j, c in enumerate(counts):
            g, n, own_ctx, _ = c[k]
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            place_ctx = np.searchsorted(ctx_keys, own_ctx)
            total = np.bincount(place_ctx, weights=n, minlength=len(ctx_keys))
            kinds = np.bincount(place_ctx, minlength=len(ctx_keys))
            seen = total > 0
            w[seen, j] = np.minimum(1.0, discount * kinds[seen] / total[seen])
            mine = np.searchsorted(keys, g)
            p[mine, j] = np.maximum(n - discount, 0) / total[place_ctx]
        if k == 1:
            uniform = 1.0 / (len(keys) + 1)
            floor = np.log(w[0] * uniform).astype(np.float32)
            p += w[at_ctx] * uniform
        else:
            at, found = _find(grams[k - 1], suffix)
            below = np.where(found[:, None], lower[at], np.exp(floor)[None, :])
            p += w[at_ctx] * below
        lower = p
        grams.append(keys)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(ctx_keys)
        backoff.append(np.log(w).astype(np.float32))
    return Model(langs, grams, logp, contexts, backoff, floor, np.full((3, len(langs)), np.inf))


def _judged(model: Model, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(column of the best language, its lead over the next in nats over the whole sentence)."""
    ce = model.cross_entropy(pieces)
    ends = np.sort(ce, axis=1)
    lead = (ends[:, 1] - ends[:, 0]) if len(model.langs) > 1 else np.full(len(pieces), np.inf)
    return ce.argmin(axis=1), lead * np.fromiter(map(len, pieces), dtype=float, count=len(pieces))


def train(labelled: dict[str, list[str]]) -> Model:
    """Fit by label, purify, fit again, and calibrate on every tenth sentence, which is held out.

    First fit: each half of the sentences is judged by models of the other half; those stay whose language is that of
    their label, with some lead. Second fit: on those; then every sentence of the sample counts for the language it is
    clearly given, whatever its label. A wrong label thus feeds no final model.
    """
    # How often a sentence stands under a label is the evidence, so repeats stay; they alternate between the halves.
    pairs = sorted((x, p) for x, v in labelled.items() for p in v)
    langs = sorted({x for x, _ in pairs})
    if not langs:
        return fit({})
    clean: dict[str, list[str]] = {x: [] for x in langs}
    for side in (0, 1):
        other, mine = pairs[1 - side :: 2], pairs[side::2]
        model = fit({x: [p for y, p in other if y == x] for x in langs})
        if not model.langs or not mine:
            continue
        best, lead = _judged(model, [p for _, p in mine])
        for (x, p), j, m in zip(mine, best, lead):
            if model.langs[j] == x and m >= SOME_LEAD:
                clean[x].append(p)
    second = fit({x: clean[x] or [p for y, p in pairs if y == x] for x in langs})
    best, lead = _judged(second, [p for _, p in pairs])
    by: dict[str, list[str]] = {x: [] for x in second.langs}
    for (x, p), j, m in zip(pairs, best, lead):
        if m >= CLEAR_LEAD or (second.langs[j] == x and m >= SOME_LEAD):
            by[second.langs[j]].append(p)
    model = fit({x: [p for i, p in enumerate(v) if i % 10] or v or clean[x] for x, v in by.items()})
    held = [(model.langs.index(x), p) for x, v in by.items() for i, p in enumerate(v) if i % 10 == 0 and x in model.langs]
    if held:
        truth, own = np.array([j for j, _ in held]), [p for _, p in held]
        ce = model.cross_entropy(own)
        mine = ce[np.arange(len(own)), truth]
        lengths = np.array([len(p) for p in own], dtype=float)
        # Rejection: beyond what its own held-out pieces reach, and what pieces of other languages begin with. The mean over a piece varies with the root of its length.
        off = (mine - mine.mean()) * np.sqrt(lengths)
        for j in range(len(model.langs)):
            x, foreign = off[truth == j], ce[truth != j, j]
            model.reject[0, j] = np.quantile(foreign, 0.05) if len(foreign) > 4 else 0
            model.reject[1, j] = mine.mean()
            model.reject[2, j] = max(x.mean() + 8 * x.std() if len(x) > 4 else 0, 8 * off.std())
        z = -(ce - mine[:, None]) * lengths[:, None]
        loss = [(np.log(np.exp(np.minimum(z * t, 50)).sum(axis=1)).mean(), t) for t in (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0)]
        model.temperature = min(loss)[1]
    return model


def labelled_sample(docs: DataFrame, text: str, label: str, id_: str, per_language: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """Sentences by language of a bounded sample of labelled documents with an id, chosen by a hash of it.

    Labels and ids of all documents are read first, each task keeping no more than ``per_language`` a language; then the text of those chosen.
    """
    order = F.xxhash64(F.col(id_), F.lit("sample")).alias("o")
    first = Window.partitionBy("l").orderBy("o")
    known = docs.where(F.col(id_).isNotNull() & F.col(text).isNotNull())
    chosen = known.select(named_language(F.col(label)).alias("l"), order).where("l is not null").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    keys = [x.o for x in chosen.select("o").distinct().collect()]  # at most per_language a language
    picked = known.where(order.isin(keys)).select(named_language(F.col(label)).alias("l"), order, F.col(text).alias("t")).where("l is not null")
    picked = picked.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)  # an id may stand in many rows
    out: dict[str, list[str]] = {}
    for row in picked.select("l", "o", "t").orderBy("l", "o").collect():
        out.setdefault(row.l, []).extend(p for _, p, _ in sentences(row.t))
    return out


_FIELDS = {"para_no": (T.LongType(), pa.int64()), "seg_no": (T.LongType(), pa.int64()), "lang": (T.StringType(), pa.string()), "confidence": (T.DoubleType(), pa.float64()), "letters": (T.LongType(), pa.int64()), "sentence_letters": (T.LongType(), pa.int64())}
_SEGMENT = T.StructType([T.StructField(k, v[0]) for k, v in _FIELDS.items()])
_ARROW_SEGMENT = pa.struct([(k, v[1]) for k, v in _FIELDS.items()])


class Judge:
    """Judges pieces by a model; pieces that come again are not scored again."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[int, int, float, np.ndarray | None]] = {}  # piece -> letters, language, confidence, posterior where it is not clear

    def learn(self, raw: Iterable[str]) -> None:
        if len(self.known) > KNOWN_LIMIT:
            self.known.clear()
        new = [x for x in dict.fromkeys(raw) if x not in self.known]
        words = [plain(x) for x in new]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
        post, rejected = self.model.posteriors(list(distinct))
        best, sure = (post.argmax(axis=1), post.max(axis=1)) if len(self.model.langs) else (np.zeros(len(post), int), np.zeros(len(post)))
        for x, w in zip(new, words):
            i = distinct[w]
            self.known[x] = (len(w) - w.count(" "), -1 if rejected[i] else int(best[i]), float(sure[i]), None if rejected[i] or sure[i] >= CLEAR else post[i])

    def segments(self, found: list[tuple[int, str, bool]]) -> list[dict]:
        """Neighbouring pieces of one paragraph and language as one segment; its confidence is the mean by letters."""
        out: list[dict] = []
        at = 0
        while at < len(found):
            para, to = found[at][0], at
            while to < len(found) and found[to][0] == para:
                to += 1
            judged = [(*self.known[x], aside) for _, x, aside in found[at:to]]
            own = [j for j, x in enumerate(judged) if x[0] and x[1] >= 0 and x[3] is None]
            where, seg = 0, 0
            for j, (letters, lang, sure, post, aside) in enumerate(judged):
                if not letters:
                    continue
                if post is not None and own:
                    while where + 1 < len(own) and abs(own[where + 1] - j) < abs(own[where] - j):
                        where += 1
                    post = post.copy()
                    post[judged[own[where]][1]] *= NEIGHBOUR
                    lang = int(post.argmax())
                    sure = float(post[lang] / post.sum())
                elif not own and letters < ORDER:
                    continue
                name = self.model.langs[lang] if lang >= 0 else None
                if out and out[-1]["para_no"] == para and out[-1]["lang"] == name:
                    s = out[-1]
                    s["confidence"] = (s["confidence"] * s["letters"] + sure * letters) / (s["letters"] + letters)
                    s["letters"] += letters
                    s["sentence_letters"] += 0 if aside else letters
                else:
                    out.append({"para_no": para, "seg_no": seg, "lang": name, "confidence": sure, "letters": letters, "sentence_letters": 0 if aside else letters})
                    seg += 1
            at = to
        return out


_JUDGES: dict[str, Judge] = {}  # of one worker; the last model only


def _judge(key: str, model: Model) -> Judge:
    if key not in _JUDGES:
        _JUDGES.clear()
        _JUDGES[key] = Judge(model)
    return _JUDGES[key]


def identify(docs: DataFrame, *, text: str = "text", label: str = "lang", id_: str = "doc_id", out: str = "segments", per_language: int = SAMPLE_DOCS, model: Model | None = None) -> DataFrame:
    """``docs`` without ``text`` and with ``out``: segments (para_no, seg_no, lang, confidence, letters, sentence_letters) in order."""
    model = model or train(labelled_sample(docs, text, label, id_, per_language))
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # bounded by the sample
    kept = [c for c in docs.columns if c not in (text, out)]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.ArrayType(_SEGMENT))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(key, shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [pieces(t) for t in part.column(text).to_pylist()]
                judge.learn(x for r in rows for _, x, _ in r)
                got = [judge.segments(r) for r in rows]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(got, type=pa.list_(_ARROW_SEGMENT))], names=[*kept, out])

    return docs.select(*kept, text).mapInArrow(run, schema)


def paragraph_languages(found: DataFrame, *, id_: str = "doc_id", segments: str = "segments", least: int = LEAST_LETTERS) -> DataFrame:
    """(id, para_no, para_lang, letters) of the languages with at least ``least`` letters of sentences; no shuffle, one row at a time."""
    keys = F.array_distinct(F.transform(F.filter(segments, lambda s: s["lang"].isNotNull()), lambda s: F.struct(s["para_no"].alias("p"), s["lang"].alias("l"))))
    sums = F.transform(keys, lambda k: F.struct(k["p"].alias("para_no"), k["l"].alias("para_lang"), F.aggregate(F.filter(segments, lambda s: (s["para_no"] == k["p"]) & (s["lang"] == k["l"])), F.lit(0).cast("long"), lambda a, s: a + s["sentence_letters"]).alias("letters")))
    rest = [c for c in found.columns if c not in (id_, segments)]
    return found.select(id_, *rest, F.inline(F.filter(sums, lambda s: s["letters"] >= least)))


def document_languages(found: DataFrame, *, id_: str = "doc_id", segments: str = "segments") -> DataFrame:
    """(id, doc_lang, confidence): the language with most letters (ties: by code), its share of letters times its mean confidence."""
    known = F.filter(segments, lambda s: s["lang"].isNotNull())
    langs = F.array_sort(F.array_distinct(F.transform(known, lambda s: s["lang"])))
    per = F.transform(langs, lambda g: F.struct(
        F.aggregate(F.filter(known, lambda s: s["lang"] == g), F.lit(0).cast("long"), lambda a, s: a + s["letters"]).alias("n"),
        F.aggregate(F.filter(known, lambda s: s["lang"] == g), F.lit(0.0), lambda a, s: a + s["letters"] * s["confidence"]).alias("c"), g.alias("l"),
    ))
    best = F.aggregate(per, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("c"), F.lit(None).cast("string").alias("l")), lambda a, x: F.when(x["n"] > a["n"], x).otherwise(a))
    total = F.aggregate(F.col(segments), F.lit(0).cast("long"), lambda a, s: a + s["letters"])
    return found.withColumn("_b", best).select(id_, F.col("_b.l").alias("doc_lang"), F.when(total > 0, F.col("_b.c") / total).otherwise(F.lit(0.0)).alias("confidence"))
