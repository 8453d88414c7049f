import hashlib
import random
import re

from codeloom.llm import personal_data as pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return 12 <= len(d) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def base(text):
    out = [(m.start(), n, f"{k}:{m.start()}:{m.end()}", k) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(k, m.group(0))]
    out.sort()
    return (*(sum(x[3] == k for x in out) for k in PLAIN), hashlib.sha256(",".join(x[2] for x in out).encode()).hexdigest()), [x[2] for x in out]


def compare(docs, rows):
    got = pii.spans(docs).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(map(repr, ((i, *base(t)[0]) for i, t in rows)))
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        key = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert key == sorted(key)
    return got


ODD = ["a@b.c%d@e.f", "x@y.z@w.v", "é 1.2.3.4.5.6.7.8 ñ", "1.2.3.4.5", "256.1.1.1 001.002.003.255", "0000000000000000255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 0000000000000000", "4111  1111 1111 1111", "1 2 3", "+1 (389) 555-5010", "+1 (389) 555-50104444444",
       "++1 234567890", "+1", "+1 2345678901 +49 30 1234567", "🎉 jo@a.b 🎉 +1 (389) 555-5010 🎉 4111111111111111 9.9.9.9", "a@b", "@b.c", "a.b@c-.d-", "1" * 3000, "4 " * 700, "a" * 40_000, "a@" * 400, "+" * 300 + "1", ("x1@y2.z3 " * 1500), "4111111111111111" * 2, "4111111111111111,4111111111111111"]


def test_base_spans_against_plain_patterns(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    rng = random.Random(9)
    rows += [(300 + i, "".join(rng.choice(["1", "23", "4111111111111111", ".", "-", " ", "+", "@", "a", "é", "(", ")", "%", "255", "\n"]) for _ in range(rng.randint(1, 80)))) for i in range(300)]
    compare(make_docs(rows), rows)
    assert pii.spans(make_docs([])).count() == 0


def test_the_method_adds_secrets(make_docs):
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789") + rng.choice("abcdef") for _ in range(20))
    rows = [(i, f'some words token = "{key()}" and more') for i in range(40)]
    rows += [(100 + i, f"see /part{i % 10}/of-a-long-path{i % 10}/a_b_c_d for it") for i in range(40)]
    got = {r["doc_id"]: r["spans"] for r in compare(make_docs(rows), rows)}
    assert all(got[i] == "secret:20:60" for i in range(40))
    assert not any("secret" in got[100 + i] for i in range(40))


def test_reliabilities_recover_the_truth():
    rng, counts, truth = random.Random(1), {}, {}
    for _ in range(5000):
        y = rng.random() < 0.4
        votes = tuple((1 if (rng.random() < p) == y else -1) if rng.random() < 0.8 else 0 for p in (0.95, 0.8, 0.8, 0.7))
        counts["ip", *votes] = counts.get(("ip", *votes), 0) + 1
        truth.setdefault(("ip", *votes), []).append(y)
    post = pii.reliabilities(counts)
    right = sum(sum(y == (post[v] >= 0.5) for y in own) for v, own in truth.items())
    assert right / 5000 > 0.85
