import random
import re
from collections import Counter, defaultdict

from lakeline.llm.lines import flag_lines, line_key, remove_lines

SCHEMA = "id string, site string, text string, parts map<string,string>, hot string, s string, h int"
HOW = dict(doc="id", source="site", text="text", parts="parts")


def key(line):
    s = re.sub(r"\d+", "0", line.lower())
    return re.sub(r"\s+", " ", s).strip(" .,:;!?-–|*")


def brute(rows):
    docs, count = defaultdict(set), defaultdict(set)
    for i, site, text, *_ in rows:
        if site is not None and text is not None:
            docs[site].add(i)
            for x in text.split("\n"):
                count[site, key(x)].add(i)
    hot = {k for k, v in count.items() if k[1] and len(v) >= 0.1 * len(docs[k[0]]) - 1e-9}
    return {(i, place, n) for i, site, text, parts, *_ in rows for place, v in [("text", text), *(parts or {}).items()] if v is not None for n, x in enumerate(v.split("\n")) if (site, key(x)) in hot}


def rows(n=200, seed=0):
    r = random.Random(seed)
    spell = ["Side 3 af 12", " side 77 AF 1 |", "– Side 1  af 2 –", "**Følg os**", "følg os!", "---", "", " "]
    out = []
    for i in range(n):
        site = r.choice(["big", "big", "small", None])
        lines = [f"Nr {chr(97 + i % 26)}{chr(97 + i // 26)} x" for _ in range(2)] + [x for x in spell if r.random() < 0.12]
        r.shuffle(lines)
        text = None if r.random() < 0.05 else "\n".join(lines)
        out.append((f"d{i}", site, text, None if r.random() < 0.3 else {"A": text or "Side 1 af 1", "B": None, "C": ""}, "x", "y", 1))
    return out + out[:20]  # some stand twice


def test_flags(spark):
    data = rows()
    got = {tuple(r) for r in flag_lines(spark.createDataFrame(data, SCHEMA), **HOW).select("id", "place", "line_no").collect()}
    assert got == brute(data) and got


def test_removal_keeps_rows_and_columns(spark):
    data = rows(seed=3)
    df = spark.createDataFrame(data, SCHEMA)
    out = remove_lines(df, **HOW)
    hot = brute(data)
    want = Counter((i, site, text if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, "text", n) not in hot)) for i, site, text, *_ in data)
    assert out.columns == df.columns and Counter((r.id, r.site, r.text) for r in out.collect()) == want
    assert all(r.parts is None or set(r.parts) == {"A", "B", "C"} for r in out.collect())


def test_spellings(spark):
    same = ["Side 3 af 12", "\tSIDE 99  af 1 |", "* - side 1 af 0.!?"]
    df = spark.createDataFrame([(x,) for x in same], "x string")
    assert {r[0] for r in df.select(line_key(df.x)).collect()} == {"side 0 af 0"}


def test_long_lines_hot_source_and_empty(spark):
    assert flag_lines(spark.createDataFrame([], SCHEMA), **HOW).count() == 0
    long = "-" * 300_000 + "x" + " ." * 100_000
    data = [(f"d{i}", "one", f"{long}\nown line {chr(97 + i)}", None, None, None, None) for i in range(20)]
    got = flag_lines(spark.createDataFrame(data, SCHEMA), **HOW)
    assert {r.line_no for r in got.collect()} == {0} and got.count() == 20
