"""Base spans against Python's regexes, the aggregation of votes, odd rows."""

import hashlib
import random
import re

from siltbed.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in match.split(".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 10 <= len(digits) <= 15}[kind]()


def base(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text or "") if valid(kind, m.group())]
    return [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def check(df):
    texts = df.select("doc_id", "text").collect()
    got = {}
    for r in pii.digest(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(texts)
    for i, t in texts:
        want = base(t)
        for kind in pii.KINDS:
            assert any(r[f"n_{kind}"] == sum(w.startswith(kind) for w in want) for r in got[i])
        assert any(r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= {*r.spans.split(",")} | set() for r in got[i]) or not want
    return got


def test_base_spans_match_brute_force(make, spark):
    r = random.Random(1)
    rows = ["a@b.c_d@e.f.g x..y@z.co a@@b.c é@ü.com x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.1.1 12345678901.2.3.4 00000000000000000000255.1.1.1",
            "4111 1111 1111 1111 4111-1111-1111-1111x4111111111111112 4111  1111", "+1 (555) 123-4567 +49 30 123456 +1 +12 +++1-2-3-4-5-6-7-8-9-0 +1 234 567 8901 - ",
            "9" * 20_000, "a" * 20_000 + "@b.c", "1 " * 9_000, "+1" + "(" * 5_000, "字 x@y.zz 字 1.2.3.4"]
    for alphabet in ("abcZ019 .@+-()_\n%é5", "0123456789 -.+()", "ab.@-_"):
        rows += ["".join(r.choice(alphabet) for _ in range(r.randint(5, 120))) for _ in range(150)]
    check(make([(i, t, "en", "s") for i, t in enumerate(rows)]))
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_added_spans(make):
    rows = [(i, f"please call ({200 + i}) 555-{1000 + i} or write to user{i}@mail{i}.example.com today", "en", "s") for i in range(100, 160)]
    rows += [(i, "order number 12345 67890 12345 and version 1.2.3 of 2020-01-02", "en", "s") for i in range(30)]
    got = {r.doc_id: r for r in pii.digest(make(rows)).collect()}
    for i in range(100, 160):
        assert "phone:12:26" in got[i].spans and got[i].n_phone == 0 and got[i].n_email == 1
    assert all(got[i].spans == "" for i in range(30))


def test_em_finds_the_reliable_labelers():
    r = random.Random(3)
    counts = {}
    for _ in range(20_000):
        truth = r.random() < 0.3
        vote = lambda right, speak: 1 if r.random() > speak else 2 if (truth if r.random() < right else not truth) else 0
        key = (vote(0.95, 0.9), vote(0.9, 0.8), vote(0.85, 0.9), vote(0.5, 0.9))
        counts[key] = counts.get(key, 0) + 1
    belief, table = pii.reliabilities([("email", k, n) for k, n in sorted(counts.items())])
    right = [table[j, 1][2] / (table[j, 1][2] + table[j, 1][0]) for j in range(4)]
    assert right[0] > 0.9 and right[1] > 0.8 and abs(right[3] - 0.5) < 0.1
    share = sum(belief["email", k] * n for k, n in counts.items()) / 20_000
    assert abs(share - 0.3) < 0.05


def test_odd_rows(odd, none):
    got = check(odd)
    assert got[2][0].spans == "" and len(got[5]) == 2 and None in got
    assert pii.digest(none).collect() == []
