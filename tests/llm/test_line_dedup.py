"""Line dedup against every pair of lines, with long lines, hot templates and odd rows."""

import random
import re

from siltbed.llm import line_dedup as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    a, b = (a, b) if len(a) < len(b) else (b, a)
    return a[i:] == b[i + 1:]


def plain(rows, near_words=8):
    """Texts after dedup, by (doc_id, text) in any order."""
    lines = []
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            words = WORD.findall(line)
            if words:
                lines.append(((2**63 if i is None else i, k), line, words))
    lines.sort(key=lambda x: x[0])
    gone, seen = set(), {}
    for place, line, words in lines:
        first = seen.get(line)
        near = any(max(len(w), len(words)) >= near_words and within_one(w, words) for other, (p, w) in seen.items() if other != line and p < (first[0] if first else place))
        if first and first[0] < place or near:
            gone.add(place)
        if not first:
            seen[line] = (place, words)
    out = []
    for i, t in rows:
        key = 2**63 if i is None else i
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (key, k) not in gone)))
    return out


def check(make, rows, **kw):
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in L.dedup_lines(make([(i, t, "en", "s") for i, t in rows]), **kw).collect()), key=str)
    want = sorted(((i, t, None if t is None else len(t)) for i, t in plain(rows)), key=str)
    assert got == want


def test_edits_of_every_kind_at_every_place(make):
    base = "the quick brown fox jumps over a lazy dog near the old mill pond".split()
    r = random.Random(5)
    rows = [(0, " ".join(base))]
    for i in range(len(base)):
        rows += [(len(rows) + 1, " ".join(base[:i] + ["new"] + base[i + 1:])), (len(rows) + 2, " ".join(base[:i] + base[i + 1:])),
                 (len(rows) + 3, "other line\n" + " ".join(base[:i] + ["in"] + base[i:]))]
    rows += [(len(rows) + 5 + k, "  ".join(r.choice([*base, "x", "y"]) for _ in range(r.randint(1, 16)))) for k in range(60)]
    r.shuffle(rows)
    check(make, rows)


def test_random_lines_of_few_words(make):
    r = random.Random(6)
    rows = [(i, "\n".join(" ".join(r.choice("ab") for _ in range(r.randint(0, 10))) for _ in range(3))) for i in range(60)]
    check(make, rows)


def test_hot_template_and_long_lines(make):
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, f"this template line has the number {i} in it and nothing else") for i in range(200)]
    rows += [(1000, " ".join(words)), (1001, " ".join(words[:1500] + ["odd"] + words[1500:])), (1002, " ".join(words[:2999])), (1003, " ".join(words[2:]))]
    check(make, rows)


def test_odd_rows(odd, none, make):
    got = L.dedup_lines(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    texts = {}
    for r in got.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[2] == [None] and texts[3] == [""] and texts[4] == [" \n\t "] and texts[5] == ["", ""] and texts[None] == ["no id here but words"]
    assert L.dedup_lines(none).collect() == []
    check(make, [(None, "a b"), (1, "a b\n\na b"), (2, "\n"), (3, "a  b")])


def test_ends_and_rests_hold_for_every_pair(spark):
    """Two lines within an edit share an end, and a rest that has the edit in its segment; lines too short for the near rule have no ends."""
    from pyspark.sql import functions as F

    r = random.Random(8)
    rows = []
    for k in range(300):
        n = r.choice([7, 8, 9, 12, 20, 65, 90])
        a = [f"{k}-{i}" for i in range(n)]
        i = r.randrange(n)
        b = r.choice([a[:i] + a[i + 1:], a[:i] + ["z"] + a[i + 1:], a[:i] + ["z"] + a[i:]])
        rows.append((k, a, b))
    df = spark.createDataFrame(rows, "k int, a array<string>, b array<string>")
    ends = {c: L.with_ends(df.select("k", F.array_join(c, r.choice([" ", " \t ", "  "])).alias("line")), 8).select("k", F.col("ends").alias(f"e{c}")) for c in "ab"}
    both = df.join(ends["a"], "k").join(ends["b"], "k").select("k", F.arrays_overlap("ea", "eb").alias("ends"), *(
        F.transform(F.concat(L._rests(F.col(c), F.size(c)), L._rests(F.col(c), F.size(c) - 1)), lambda x: x["key"]).alias(f"r{c}") for c in "ab"))
    sizes = {k: (len(a), len(b)) for k, a, b in rows}
    assert min(max(s) for s in sizes.values()) == 7  # some pairs are outside the near rule: their longer line has under 8 words
    for x in both.select("k", "ends", F.arrays_overlap("ra", "rb").alias("rests")).collect():
        if max(sizes[x.k]) >= 8:
            assert x.ends and x.rests, x
    for c, side in (("a", 0), ("b", 1)):
        none = {r.k for r in ends[c].where(f"e{c} is null").collect()}
        assert none == {k for k, s in sizes.items() if s[side] < 7}


def test_rows_of_one_id_or_none_with_different_texts(make):
    """A line goes from the row that repeats it, and from no other row of the same id."""
    rows = [(1, "first"), (9, "first"), (9, "second text"), (None, "first\nalpha"), (None, "beta one\nomega"), (None, "gamma"),
            (7, "left\nshared here"), (7, "right\nshared here"), (None, "up\nboth have it"), (None, "down\nboth have it")]
    got = {}
    for x in L.dedup_lines(make([(i, t, "en", "s") for i, t in rows])).collect():
        assert x.n_chars == len(x.text)
        got.setdefault(x.doc_id, []).append(x.text)
    assert got[1] == ["first"] and sorted(got[9]) == ["", "second text"]
    assert sorted(got[7]) in (["left", "right\nshared here"], ["left\nshared here", "right"])
    assert {"alpha", "beta one\nomega", "gamma"} <= set(got[None])
    assert sorted(x for x in got[None] if x.startswith(("up", "down"))) in (["down", "up\nboth have it"], ["down\nboth have it", "up"])


def test_hot_and_other_lines_drop_the_same_places(make):
    passage = "a passage that very many of the documents have in common with one another"
    rows = [(i, f"{passage}\nline {i % 7}\nown line {i} of this document and of no other one at all {i}", "en", "a") for i in range(60)]
    places = lambda hot: sorted((r.place.doc, r.place.no) for r in L.dropped_lines(make(rows), hot_lines=hot).collect())
    every = places(1000)
    assert every == places(1) == places(4)  # all lines broadcast, none, the passage alone
    assert len([p for p in every if p[1] == min(n for _, n in every)]) == 59
