"""Personal data: the fixed patterns against Python's re, the added spans on planted values."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from starloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NO_TREES = pii.Trees()


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def passes(kind, body):
    digits = re.sub("[^0-9]", "", body)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in body.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


def card(start, size=16):
    body = start + "0" * (size - 1 - len(start))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


TEXTS = [
    None,
    "",
    "a@b.c d_e@f.g@h.i a@b.c.d_e@f.g, x@y x@@z.w ..@-.- ünï@a.bc e@a.b.",
    "a@b.c.d_e@f.g+h@i.j" + "x@y.z" * 5,
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.02.3.255 1.2.3 01234.1.1.1 9.9.9.9.9",
    f"{card('4')} {card('55')}x{card('37', 15)}-{card('4', 13)} 4111-1111 1111 1111 1111 1111 12 3",
    f"ümläut 😀 {card('4')} 😀 +1 (988) 555-2485 4524132264652876 +12 +1 2 +123456789 +49 30 1234567. +1(2)",
    "+1 (988) 555-2485" + "+44 20 7946 0958" + "+" * 5 + "9" * 16 + "-" * 9,
    "7" * 40 + " " + " 1" * 30 + "\n5-5-5-5--6 6  7",
]


def scan(spark, texts, trees=NO_TREES):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    found = pii.scanned(docs, "text", trees, ["doc_id"])
    return {r.doc_id: r for r in pii.digest(found, ["doc_id"]).collect()}


def test_fixed_spans_equal_plain_search(spark):
    found = scan(spark, TEXTS)
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        spans = brute(text)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i].spans == written, text
        assert found[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        counts = [getattr(found[i], f"n_{k}") for k in pii.KINDS]
        assert counts == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_very_long_texts(spark):
    """Whole texts in time that grows with them; plain search needs the square for some of these."""
    block = "10.1.2.3 me@here.org " + card("4") + " x "
    many = [
        (kind, n * len(block) + a, n * len(block) + b)
        for n in range(5_000)
        for kind, a, b in (("ip", 0, 8), ("email", 9, 20), ("card", 21, 37))
    ]
    order = list(pii.KINDS)
    texts = {
        "a" * 1_000_000 + "@": [],
        "a.b" * 300_000 + "@x.y": [("email", 0, 900_004)],
        "1" * 1_000_000 + ".1.1.1": [],
        "x@" + "a." * 200_000 + "b": [("email", 0, 400_003)],
        "+1 2 3 4 5 6 7 8 9 " * 5_000: [("phone", n * 19, n * 19 + 18) for n in range(5_000)],
        block * 5_000: sorted(many, key=lambda s: (order.index(s[0]), s[1])),
    }
    found = scan(spark, list(texts))
    for i, spans in enumerate(texts.values()):
        assert found[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans), i


def test_empty_tables_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.digest(pii.scanned(empty, "text", keep=["doc_id"]), ["doc_id"]).count() == 0
    docs = spark.createDataFrame([(None, "a@b.c")] * 3 + [(1, "nothing")] * 2, "doc_id bigint, text string")
    rows = pii.digest(pii.scanned(docs, "text", keep=["doc_id"]), ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in rows) == [(0, "email:0:5")] * 3 + [(1, "")] * 2


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with all kinds of data among words and other numbers."""
    import random

    rng = random.Random(7)
    words = "the of and to a in is that it was for on are with as his they at be this from have or by".split()

    def value(kind):
        if kind == "email":
            return f"{''.join(rng.choices('abcdefgh', k=6))}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com"
        if kind == "ip":
            return ".".join(str(rng.randint(1, 255)) for _ in range(4))
        if kind == "card":
            return card("4" + "".join(rng.choices("0123456789", k=14)))
        return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"

    def filler():
        noise = [f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", "%040x" % rng.getrandbits(160), str(rng.randint(1900, 2030))]
        return rng.choices(words, k=rng.randint(6, 14)) + (rng.choices(noise, k=1) if rng.random() < 0.4 else [])

    texts = []
    for i in range(1500):
        parts = filler()
        for _ in range(rng.randint(0, 3)):
            parts += [value(rng.choice(pii.KINDS)), *filler()]
        texts.append(" ".join(parts))
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_trees_add_what_the_patterns_miss(spark, corpus):
    trees = pii.fit(corpus, "text")
    assert set(trees.threshold) == set(pii.KINDS)
    number, other = card("4123987650"), card("4999123")
    planted = [
        (f"it was {number} {number} for", {("card", 7, 23), ("card", 24, 40)}),
        (f"was from 38.253.197.126 {other} that", {("card", 24, 40)}),
        (f"with as +1 (988) 555-2485 {number} they", {("phone", 8, 25), ("card", 26, 42)}),
        ("write abcdef.42 at mail3 dot example dot com or", {("email", 6, 44)}),
        ("a text without any, version 4.0 of 2021 and 0641917ea4e9feb9cda83477b57ac2654884f485", set()),
        (f"the {number[:-1]}{(int(number[-1]) + 1) % 10} is no card", set()),
        ("they look at the mail. That is it", set()),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(planted)], "doc_id bigint, text string")
    found = {r.doc_id: {tuple(s) for s in r.added} for r in pii.scanned(docs, "text", trees, ["doc_id"]).collect()}
    assert found == {i: spans for i, (_, spans) in enumerate(planted)}


def test_margins_follow_the_trees(spark, corpus):
    rows = pii.materialize(pii.examples(corpus, "text"), "t")
    trees = pii.grown(rows, rounds=2, depth=2)

    def walked(kind, x):
        total = 0.0
        for splits, leaves in zip(trees.splits[kind], trees.leaves[kind]):
            node = 1
            while node in splits:
                feature, value = splits[node]
                node = 2 * node + (x[feature] > value)
            total += leaves.get(node, 0.0)
        return total

    scored = rows.select("kind", "x", trees.margin().alias("m")).distinct().collect()
    assert len(scored) > 50 and all(r.m == pytest.approx(walked(r.kind, r.x)) for r in scored)
    # the first tree's weights are those of plain sums at its leaves
    kind, splits = "card", trees.splits["card"][0]
    data = rows.where(F.col("kind") == kind).collect()
    for leaf, weight in trees.leaves[kind][0].items():
        if leaf in splits:
            continue

        def at(x):
            node = 1
            while node in splits:
                node = 2 * node + (x[splits[node][0]] > splits[node][1])
            return node

        inside = [r.y for r in data if at(r.x) == leaf]
        assert weight == pytest.approx(-pii.RATE * sum(0.5 - y for y in inside) / (0.25 * len(inside) + pii.SMOOTH), abs=1e-5)


def test_thresholds_reach_the_precision(spark):
    trees = pii.Trees({"card": [{1: (0, 5)}]}, {"card": [{2: -3.0, 3: 3.0}]})
    held = spark.createDataFrame(
        [("card", [9], 1)] * 99 + [("card", [9], 0)] + [("card", [1], 1)] + [("card", [1], 0)] * 2, "kind string, x array<int>, y int"
    )
    assert pii.calibrate(trees, held, 0.98).threshold == {"card": 0.94}
    assert pii.calibrate(pii.Trees(trees.splits, trees.leaves), held, 0.995).threshold == {}


@pytest.mark.parametrize("lengths", [[], [3], [1, 0, 2], list(range(700))])
def test_running_sums(spark, lengths):
    df = spark.createDataFrame([(lengths,)], "v array<bigint>")
    assert df.select(pii.running(F.col("v"))).first()[0] == [sum(lengths[:i]) for i in range(len(lengths))]
