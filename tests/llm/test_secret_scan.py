"""Base spans against plain regexes, the tests' size and power, thresholds, odd rows."""

import base64
import hashlib
import random
import re
import time

from siltbed.llm import secret_scan as S

EITHER = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
NAMES = "|".join([*(EITHER(w) for w in ("password", "passwd", "secret", "token")), EITHER("api") + "_?" + EITHER("key")])


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out)


def test_base_spans_match_brute_force(sample_docs):
    r = random.Random(3)
    bits = ["password", "=", ":", " ", '"', "aB3", "AKIA", "XYZ12345", "0123456789abcdef", "token", "ſecret", "toKen", "apiKey", "api_key", "'", "/", "\n", "é"]
    texts = [x.text for x in sample_docs.select("text").collect()] + ["".join(r.choice(bits) for _ in range(r.randint(3, 30))) for _ in range(2000)]
    for t in texts:
        assert S.base_spans(t) == plain(t)


def test_counts_and_digest_of_the_query_match_brute_force(sample_docs, odd):
    for docs in (sample_docs, odd):
        want = []
        for r in docs.select("doc_id", "text").collect():
            spans = plain(r.text or "")
            line = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)
            want.append((r.doc_id, *(sum(k == x for _, k, _ in spans) for x in range(3)), hashlib.sha256(line.encode()).hexdigest()))
        got = S.digest(docs)
        kept = got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()
        assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))
        for r in got.collect():  # the base spans stay among all spans
            base = [x for x in (r.spans or "").split(",") if x and not x.startswith("random")]
            assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_many_base_spans_take_linear_time_and_hide_what_they_touch():
    r = random.Random(8)
    lines = [hashlib.sha256(str(i).encode()).hexdigest() + "  " + "".join(r.choice("ab9Z_/") for _ in range(r.randint(10, 30))) for i in range(40_000)]
    for text in ("\n".join(lines[:200]), "x" + lines[0] + "y token=" + lines[1] + "/" + "q" * 20):
        base = S.base_spans(text)
        free = [(m.start(), m.end()) for m in S.TOKEN.finditer(text) if not any(a < m.end() and m.start() < b for a, _, b in base)]
        assert {(a, b) for a, b, *_ in S.candidates(text, base)} == {(a, b) for a, b in free if S.encoding(text[a:b]) is not None}
    spent = []
    for n in (20_000, 40_000):
        text = "\n".join(x[:64] for x in lines[:n])
        base, best = S.base_spans(text), 9e9
        for _ in range(3):
            began = time.perf_counter()
            S.candidates(text, base)
            best = min(best, time.perf_counter() - began)
        spent.append(best)
    assert spent[1] < 3.5 * spent[0]


def random_token(r, name, n):
    raw = bytes(r.randrange(256) for _ in range(n))
    return raw.hex()[:n] if name == "hex" else base64.b64encode(raw).decode()[:n]


def test_random_tokens_pass_and_words_fail():
    r = random.Random(7)
    for name in ("hex", "base64"):
        for n in (20, 32, 64):
            p = sorted(S.combined(S.battery(random_token(r, name, n), name)) for _ in range(400))
            assert p[20] > 0.01 and p[200] > 0.3  # p-values of random tokens are spread out
    words = ["thequickbrownfoxjumpsover", "aaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz", "internationalization"]
    assert all(S.combined(S.battery(w, "base64")) < 0.01 for w in words)
    assert S.encoding("0123456789012345") is None and S.encoding("deadbeef00") == "hex" and S.encoding("a.b") is None


def test_false_discoveries_are_controlled_by_class():
    r = random.Random(9)
    ordinary = [(2, 1, min(64, int(r.expovariate(0.8))), True) for _ in range(5000)]
    secret = [(2, 1, r.randrange(20, 65), False) for _ in range(50)] + [(2, 1, min(64, int(r.expovariate(0.8))), False) for _ in range(450)]
    rows = {}
    for x in ordinary + secret:
        rows[x] = rows.get(x, 0) + 1
    least = S.thresholds([(*k, n) for k, n in rows.items()], 0.1)
    accepted = [x for x in secret if x[2] >= least[2][1]]
    assert len(accepted) >= 48 and sum(x[2] < 20 for x in accepted) <= 0.3 * len(accepted)
    assert all(t == S.SCORES + 1 for row in S.thresholds([], 0.1) for t in row)


def test_secrets_beside_the_base_rules_are_added(make):
    r = random.Random(5)
    word = lambda: "".join(r.choice(["ta", "ri", "mo", "len", "sa"]) for _ in range(9))
    rows = [(i, " ".join(word() for _ in range(40)), "en", "s") for i in range(200)]
    keys = {i: random_token(r, "base64", 40) for i in range(200, 230)}
    rows += [(i, f"{word()} key {k} {word()}", "en", "s") for i, k in keys.items()]
    got = {x.doc_id: x for x in S.digest(make(rows)).collect()}
    hits = sum(f"random:{rows[i][1].index(k)}:{rows[i][1].index(k) + len(k)}" in got[i].spans for i, k in keys.items() if not re.search("[+/]$|^[+/]", k))
    assert hits >= 22 and sum(got[i].spans != "" for i in range(200)) <= 4


def test_odd_rows(odd, none):
    got = {}
    for x in S.digest(odd).collect():
        got.setdefault(x.doc_id, []).append(x)
    assert got[2][0].spans == "" and got[2][0].n_hex == 0 and len(got[5]) == 2 and None in got
    assert S.digest(none).collect() == []


ALPHABETS = {"upper hex": "0123456789ABCDEF", "lower base32": "abcdefghijklmnopqrstuvwxyz234567", "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
             "upper base36": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "letters": "abcdefghijklmnopqrstuvwxyz", "upper letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def test_random_tokens_of_every_alphabet_pass_the_floor():
    r = random.Random(12)
    for letters in ALPHABETS.values():
        for n in (16, 24, 32, 64):
            tokens = ["".join(r.choice(letters) for _ in range(n)) for _ in range(300)]
            scores = [next(x[4] for x in S.candidates(t, []) if not x[5]) for t in tokens]
            assert sum(x < 4 for x in scores) <= 0.12 * len(scores), (letters, n)
    words = ["internationalization", "responsibilities", "characteristically", "misunderstandings", "INTERDISCIPLINARY", "telecommunications"]
    assert all(next(x[4] for x in S.candidates(w, []) if not x[5]) < 4 for w in words)


def test_secrets_in_one_case_are_found_among_words(make):
    r = random.Random(13)
    word = lambda: "".join(r.choice(["ta", "ri", "mo", "len", "sa"]) for _ in range(9))
    rows = [(i, " ".join(f"{word()} {word()}-{word()} {word().capitalize()}" for _ in range(10)), "en", "s") for i in range(100)]
    keys = {}
    for letters in ALPHABETS.values():
        for n in (16, 32):
            for _ in range(20):
                keys[1000 + len(keys)] = "".join(r.choice(letters) for _ in range(n))
    rows += [(i, f"see {k} {word()}", "en", "s") for i, k in keys.items()]
    got = {x.doc_id: x.spans for x in S.digest(make(rows)).collect()}
    hits = sum(f"random:4:{4 + len(k)}" in got[i] for i, k in keys.items())
    assert hits >= 0.8 * len(keys) and sum(got[i] != "" for i in range(100)) <= 4
