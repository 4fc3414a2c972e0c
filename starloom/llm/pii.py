"""Personal data: fixed patterns, and candidates selected by boosted trees; DataFrame functions only.

Generators propose overlapping spans: every run of one to five neighbouring groups of digits that could be a
card, a phone or an address, and every spelled-out email. Boosted trees, grown level by level from grouped
sums, rate them by their form and their surroundings. They learn from the spans that the fixed patterns find in a
bounded sample of the documents, from rewritings of these, and from the numbers of documents without any.
A threshold per kind, set on values the trees have not seen, selects what is added to the fixed patterns' spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.support import FILE, PLACE, located
from starloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Documents, as many as a hash selects of all, that the trees learn from.
FIT_DOCUMENTS = 20_000
ROUNDS, DEPTH, RATE, SMOOTH = 6, 3, 0.7, 1.0
# Of what a threshold selects among unseen labelled candidates, so much is right.
PRECISION = 0.98
FOLDS = 3  # one of them sets the thresholds
STEPS = 50  # thresholds are multiples of 1 / STEPS
CONTEXT = 32
GROUPS = 5
_UNIT = 1 << 20  # gradients are added up as whole numbers, so that reruns agree

# The patterns of the four kinds. A possessive run that may only begin where no run goes on, or where the match
# before ended, matches the same spans as a plain one but reads each character once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_HOLDS = {"email": "@", "phone": "+"}
_OCTET = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
SPELLED = (
    r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++(?:\s?[\[(](?:at|@)[\])]\s?|\sat\s|\s@\s)"
    r"[a-z0-9-]++(?:(?:\.|\s?[\[(](?:dot|\.)[\])]\s?|\sdot\s)[a-z0-9-]++)++"
)
_TIGHT = r"^[ ().-]{1,3}$"
# What the words before a number or name speak of.
CUES = (
    r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|whatsapp|sms)\b",
    r"(?i)\b(?:e-?mail|mail|write|reach|address)\b",
    r"(?i)\b(?:card|visa|master|amex|credit|debit|pay|payment)\b",
    r"(?i)\b(?:ip|host|server|network|ping|addr|login|client)\b",
    r"(?i)\b(?:version|v|license|licence|no|nr|number|id|order|ref|isbn|issn|page|item|code|token|key|serial|build)\b",
)


def running(lengths: Column) -> Column:
    """Sum of all entries before each one. Taken in slices, so that the work grows with the entries, not their square."""
    slice_of, n = 512, F.size(lengths)
    empty = F.array().cast("array<bigint>")

    def before(values: Column, start: Column) -> Column:
        first = F.struct(start.cast("bigint").alias("sum"), empty.alias("all"))
        step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all"))
        return F.aggregate(values, first, step)["all"]

    # slice() would copy the whole array each time
    slices = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / slice_of).cast("int")),
        lambda k: F.transform(
            F.sequence(k * slice_of, F.least(k * slice_of + slice_of, n) - 1), lambda j: F.get(lengths, j)
        ),
    )
    totals = F.transform(slices, lambda s: F.aggregate(s, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.when(n > 0, F.flatten(F.zip_with(slices, before(totals, F.lit(0)), before))).otherwise(empty)


def _matched(rows: DataFrame, text: str, name: str, pattern: str, only: Column) -> DataFrame:
    """``rows`` with ``name``: start, end and body of each match, in code points, and the text around it."""
    found, gaps, lengths, starts = (f"__{name}_{x}" for x in ("found", "gaps", "lengths", "starts"))
    nothing = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            found: F.when(only, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(nothing),
            gaps: F.when(only, F.split(text, pattern, -1)).otherwise(nothing),
        }
    )
    both = F.zip_with(
        F.slice(gaps, 1, F.size(found)), found, lambda g, m: (F.length(g) + F.length(m)).cast("bigint")
    )
    rows = rows.withColumn(lengths, both)
    rows = rows.withColumn(starts, running(F.col(lengths)))

    def span(m: Column, i: Column) -> Column:
        left, right = F.get(gaps, i), F.get(gaps, i + 1)
        start = F.get(starts, i) + F.length(left)
        return F.struct(
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            m.alias("body"),
            F.right(left, F.lit(CONTEXT)).alias("left"),
            F.left(right, F.lit(CONTEXT)).alias("right"),
            F.length(right).alias("gap"),
        )

    return rows.withColumn(name, F.transform(found, span)).drop(found, gaps, lengths, starts)


def _passes(kind: str, body: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(body, r"\."), lambda part: part.rlike(_OCTET))
    digits = F.regexp_replace(body, r"[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(kind: str, spans: str) -> Column:
    return F.filter(spans, lambda s: _passes(kind, s["body"]))


def _named(kind: str) -> Column:
    """The fixed spans of a kind with its name."""
    return F.transform(kind, lambda s: s.dropFields("gap").withField("kind", F.lit(kind)))


def fixed_spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the fixed patterns' spans, one array per kind, and ``doubt``: a match failed its check that may hold data."""
    digits = F.col(text).rlike(r"[0-9][^a-zA-Z]?[0-9]")
    for kind in KINDS:
        only = F.contains(text, F.lit(_HOLDS[kind])) if kind in _HOLDS else digits
        rows = _matched(rows, text, f"__all_{kind}", PATTERNS[kind], only)
    long = lambda s: F.length(F.regexp_replace(s["body"], "[^0-9]", "")) >= 9
    rows = rows.withColumns(
        {k: _checked(k, f"__all_{k}") for k in KINDS}
        | {
            "doubt": (F.size(F.filter("__all_card", long)) > 0)
            | (F.size("__all_phone") > 0)
            | (F.size("__all_ip") > 0)
        }
    )
    return rows.drop(*[f"__all_{k}" for k in KINDS])


def _class(char: Column) -> Column:
    """What a neighbouring character is: nothing or blank, letter, joining sign, quote or sign of equality, other."""
    return (
        F.when(char.rlike(r"^\s?$"), 0)
        .when(char.rlike(r"^[\p{L}\p{N}_]$"), 1)
        .when(char.rlike(r"^[-./:@#]$"), 2)
        .when(char.rlike(r"^[\"'=]$"), 3)
        .otherwise(4)
    )


def _cue(left: Column) -> Column:
    found = F.lit(0)
    for i, words in reversed(list(enumerate(CUES, 1))):
        found = F.when(left.rlike(words), i).otherwise(found)
    return found


def _windows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per run of neighbouring digit groups of 7 to 19 digits with nothing but joining signs between them."""
    ahead = F.transform(
        "__groups", lambda g, i: F.struct(g.alias("g0"), *[F.get("__groups", i + j).alias(f"g{j}") for j in range(1, GROUPS)])
    )
    rows = rows.select(*keep, F.explode(ahead).alias("g")).select(*keep, "g.*")
    runs, size, open_ = [], F.lit(0), F.lit(True)
    for j in range(GROUPS):
        g = F.col(f"g{j}")
        size = size + F.length(g["body"])
        if j:
            open_ = open_ & g.isNotNull() & (g["gap_before"] <= 3) & g["left"].rlike(_TIGHT)
        run = F.struct(F.array(*[f"g{k}" for k in range(j + 1)]).alias("run"))
        runs.append(F.when(F.coalesce(open_ & size.between(7, 19), F.lit(False)), run))
    rows = rows.select(*keep, F.explode(F.array(*runs)).alias("r")).where("r is not null").select(*keep, "r.run")
    return rows.select(
        *keep,
        "run",
        F.concat_ws("", F.transform("run", lambda g: g["body"])).alias("digits"),
        F.transform(F.slice("run", 2, GROUPS), lambda g: g["left"]).alias("signs"),
        F.get("run", F.lit(0))["left"].alias("left"),
        F.get("run", F.size("run") - 1)["right"].alias("right"),
    )


def _numbers(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Candidates of cards, phones and addresses with the features of their form and surroundings."""
    windows = _windows(rows, keep)
    opening = F.regexp_extract("left", r"(?:\+\(?|\()$", 0)
    size, groups = F.length("digits"), F.size("run")
    octets = F.transform("run", lambda g: g["body"].rlike(_OCTET))
    kinds = F.filter(
        F.array(
            F.when((groups == 4) & F.forall("signs", lambda s: s == "."), F.lit("ip")),
            F.when((size >= 13) & F.forall("signs", lambda s: s.rlike("^[ -]$")), F.lit("card")),
            F.when(size <= 15, F.lit("phone")),
        ),
        lambda k: k.isNotNull(),
    )
    rows = windows.withColumns({"opening": opening, "kind": F.explode(kinds)})
    rows = rows.withColumn("opening", F.when(F.col("kind") == "phone", F.col("opening")).otherwise(F.lit("")))
    first, last = F.get("run", F.lit(0)), F.get("run", groups - 1)
    start = first["start"] - F.length("opening")
    before = F.substring("left", F.lit(1), F.length("left") - F.length("opening"))
    signs = F.concat_ws("", "signs")
    lengths = F.transform("run", lambda g: F.length(g["body"]))
    form = [
        size,
        groups,
        F.contains("opening", F.lit("+")).cast("int"),
        F.contains(F.concat("opening", signs), F.lit("(")).cast("int"),
        F.when(signs == "", 0)
        .when(signs.rlike("^ +$"), 1)
        .when(signs.rlike("^-+$"), 2)
        .when(signs.rlike(r"^\.+$"), 3)
        .when(signs.rlike(r"^[ ()-]+$"), 4)
        .otherwise(5),
        F.call_function("luhn_check", F.col("digits")).cast("int"),
        F.array_max(lengths),
        F.array_min(lengths),
        F.length(first["body"]),
        F.length(last["body"]),
        F.substring("digits", 1, 1).cast("int"),
        F.forall(octets, lambda fits: fits).cast("int"),
        _class(F.right(before, F.lit(1))),
        _class(F.left("right", F.lit(1))),
        # another number is joined to it on that side
        before.rlike(r"[0-9][ ().-]{0,3}$").cast("int"),
        F.col("right").rlike(r"^[ ().-]{1,3}[0-9]").cast("int"),
        F.col("right").rlike(r"^\.[0-9]").cast("int") + before.rlike(r"[0-9]\.$").cast("int"),
        _cue(F.lower("left")),
    ]
    return rows.select(
        *keep,
        "kind",
        start.alias("start"),
        last["end"].alias("end"),
        F.transform("run", lambda g: g["start"]).alias("cells"),
        F.array(*[f.cast("int") for f in form]).alias("x"),
    )


def _spelled(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Candidates of emails that are written with words or brackets, with the same kind of features."""
    rows = rows.select(*keep, F.explode("__spelled").alias("s")).select(*keep, "s.*")
    name = F.regexp_extract("body", r"^[A-Za-z0-9._%+-]+", 0)
    rest = F.substring("body", F.length(name) + 1, F.length("body"))
    labels = F.split(F.regexp_replace(F.lower(rest), r"\s?[\[(](?:dot|\.)[\])]\s?|\sdot\s", "."), r"\.")
    form = [
        F.least(F.length(name), F.lit(40)),
        F.size(labels),
        F.length(F.element_at(labels, -1)),
        name.rlike("[0-9]").cast("int"),
        name.rlike("[._%+-]").cast("int"),
        F.when(rest.rlike(r"^\s?[\[(]"), 0).when(rest.rlike(r"^\s@"), 1).otherwise(2),
        rest.rlike(r"(?i)[\[(]dot|\sdot\s").cast("int"),
        rest.rlike("[0-9]").cast("int"),
        F.least(F.length("body"), F.lit(80)),
        _class(F.right("left", F.lit(1))),
        _class(F.left("right", F.lit(1))),
        _cue(F.lower("left")),
    ]
    return rows.select(
        *keep,
        F.lit("email").alias("kind"),
        "start",
        "end",
        F.array("start").alias("cells"),
        F.array(*[f.cast("int") for f in form]).alias("x"),
    )


def with_generators(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with what the candidates of a text are made of: its groups of digits and its spelled-out emails."""
    rows = _matched(rows, text, "__digits", "[0-9]++", F.col(text).rlike("[0-9]"))
    groups = F.transform(
        "__digits",
        lambda g, i: g.withField("gap_before", F.when(i == 0, CONTEXT).otherwise(F.get("__digits", i - 1)["gap"])).dropFields("gap"),
    )
    rows = rows.withColumn("__groups", groups).drop("__digits")
    spelled = F.col(text).rlike(r"(?i)[\[(](?:at|@)[\])]|\s@\s|\sat\s\S+(?:\sdot\s|[\[(]dot|\.[a-z])")
    rows = _matched(rows, text, "__spelled", SPELLED, spelled)
    return rows


def candidates(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, kind, start, end, cells and x (the features) of all candidates of ``with_generators`` rows.

    Candidates overlap. ``cells`` are the starts of their groups of digits: two candidates that
    overlap share a cell.
    """
    return _numbers(rows, keep).unionByName(_spelled(rows, keep))


@dataclass
class Trees:
    """Per kind: trees as {node: (feature, value)} with leaves {node: weight}, and the threshold on the probability."""

    splits: dict[str, list[dict[int, tuple[int, int]]]] = field(default_factory=dict)
    leaves: dict[str, list[dict[int, float]]] = field(default_factory=dict)
    threshold: dict[str, float] = field(default_factory=dict)

    def _walk(self, kind: str, tree: int, result, node: int = 1) -> Column:
        split = self.splits[kind][tree].get(node)
        if split is None:
            return F.lit(result(node))
        low, high = (self._walk(kind, tree, result, 2 * node + side) for side in (0, 1))
        return F.when(F.get("x", F.lit(split[0])) <= split[1], low).otherwise(high)

    def node(self, kind: str, tree: int) -> Column:
        """The node of ``tree`` that a candidate of ``kind`` ends in."""
        return self._walk(kind, tree, lambda node: node)

    def margin(self, only: int | None = None) -> Column:
        """Log odds of all trees, or of one; 0 for kinds without trees. ``x`` should be a stored column."""
        total = F.lit(0.0)
        for kind, trees in self.splits.items():
            weight = F.lit(0.0)
            for tree in range(len(trees)) if only is None else [only]:
                weight = weight + self._walk(kind, tree, lambda node, t=tree, k=kind: self.leaves[k][t].get(node, 0.0))
            total = F.when(F.col("kind") == kind, weight).otherwise(total)
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def _gain(g: float, h: float) -> float:
    return g * g / (h + SMOOTH)


def _weight(g: float, h: float) -> float:
    return -RATE * g / (h + SMOOTH)


def _best_split(values: dict[int, dict[int, tuple[float, float]]]) -> tuple[int, int, tuple, tuple]:
    """(feature, value, sums below, sums above) of the best cut by gradient sums per feature and value; feature -1: none."""
    best, found = 1e-3, (-1, 0, (0.0, 0.0), (0.0, 0.0))
    for feature, sums in sorted(values.items()):
        all_g, all_h = (sum(s[i] for s in sums.values()) for i in (0, 1))
        g = h = 0.0
        for value in sorted(sums)[:-1]:
            g, h = g + sums[value][0], h + sums[value][1]
            if min(h, all_h - h) < 0.5:
                continue
            gain = _gain(g, h) + _gain(all_g - g, all_h - h) - _gain(all_g, all_h)
            if gain > best + 1e-9:
                best, found = gain, (feature, value, (g, h), (all_g - g, all_h - h))
    return found


def grown(examples: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees:
    """Boosted trees from ``kind``, ``x`` and ``y`` (0 or 1), all kinds at once, one grouped sum per level.

    Per level, kind and node the driver gets one row per feature and value, whatever the number of examples.
    Kinds that lack examples of either sort get no trees. The margin of the trees so far is a
    column of a written table, so no round repeats the one before.
    """
    trees = Trees()
    sides = examples.groupBy("kind").agg(F.min("y").alias("low"), F.max("y").alias("high")).collect()
    for row in sides:
        if (row.low, row.high) == (0, 1):
            trees.splits[row.kind], trees.leaves[row.kind] = [], []
    kinds = sorted(trees.splits)
    if not kinds:
        return trees
    rows = examples.where(F.col("kind").isin(kinds)).select("kind", "x", "y", F.lit(0.0).alias("margin"))
    rows = rows.groupBy("kind", "x", "y", "margin").agg(F.count("*").alias("weight"))
    rows = materialize(rows, "pii-examples")
    for tree in range(rounds):
        for kind in kinds:
            trees.splits[kind].append({})
            trees.leaves[kind].append({})
        p = 1 / (1 + F.exp(-F.col("margin")))
        whole = lambda c: F.round(c * _UNIT).cast("bigint") * F.col("weight")
        for level in range(depth):
            node = F.lit(0)
            for kind in kinds:
                node = F.when(F.col("kind") == kind, trees.node(kind, tree)).otherwise(node)
            entries = rows.select(
                "kind",
                node.alias("node"),
                F.posexplode("x").alias("feature", "value"),
                whole(p - F.col("y")).alias("g"),
                whole(p * (1 - p)).alias("h"),
            ).where(F.col("node") >= 1 << level)
            sums = entries.groupBy("kind", "node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            found: dict[tuple, dict] = {}
            for r in sums.collect():
                found.setdefault((r.kind, r.node), {}).setdefault(r.feature, {})[r.value] = (r.g / _UNIT, r.h / _UNIT)
            for (kind, at), values in sorted(found.items()):
                feature, value, low, high = _best_split(values)
                leaves = trees.leaves[kind][tree]
                if feature < 0:
                    leaves.setdefault(at, _weight(*map(sum, zip(*values[0].values()))))
                    continue
                trees.splits[kind][tree][at] = (feature, value)
                leaves[2 * at], leaves[2 * at + 1] = _weight(*low), _weight(*high)
        if not any(trees.splits[kind][tree] for kind in kinds):
            break
        rows = materialize(rows.withColumn("margin", F.col("margin") + trees.margin(tree)), "pii-margin")
    return trees


def calibrate(trees: Trees, held_out: DataFrame, precision: float = PRECISION) -> Trees:
    """Set each kind's threshold: the lowest at which the share of true ones among all above reaches ``precision``.

    It never lies below a step of the probability at which most are wrong. A kind without such a threshold, or without unseen examples, selects nothing.
    """
    step = F.floor(trees.probability() * STEPS).cast("int").alias("step")
    if not trees.splits:
        return trees
    counts = held_out.select("kind", "y", step).groupBy("kind", "step").agg(F.sum("y").alias("right"), F.count("*").alias("all"))
    per: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts.collect():
        per.setdefault(r.kind, {})[r.step] = (r.right, r["all"])
    for kind, steps in per.items():
        right = total = 0
        for step_of in sorted(steps, reverse=True):
            if 2 * steps[step_of][0] < steps[step_of][1]:
                break
            right, total = right + steps[step_of][0], total + steps[step_of][1]
            if right >= precision * total:
                trees.threshold[kind] = step_of / STEPS
    return trees


def _rewritten(kind: Column, body: Column, left: Column) -> Column:
    """Array of (before, body, after, good) variants: other ways to write the value, and values that are none."""
    digits = F.regexp_replace(body, "[^0-9]", "")
    last = F.right(digits, F.lit(1)).cast("int")
    wrong = F.concat(F.left(digits, F.length(digits) - 1), ((last + 1) % 10).cast("string"))
    other = F.substring(F.conv(F.substring(F.sha2(body, 256), 1, 12), 16, 10), 1, 12)
    local = F.right(digits, F.lit(10))
    parts = lambda a, b, c: F.concat(F.lit(a), F.substring(local, 1, 3), F.lit(b), F.substring(local, 4, 3), F.lit(c), F.substring(local, 7, 4))
    fours = lambda s, d: F.rtrim(F.regexp_replace(d, "([0-9]{4})(?=[0-9])", "$1" + s))

    def variant(before, text, after, good):
        as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
        return F.struct(
            as_col(before).alias("before"), as_col(text).alias("body"), as_col(after).alias("after"), F.lit(good).alias("good")
        )

    def spelled(at, dot):
        return F.regexp_replace(F.regexp_replace(body, "@", at), r"\.(?=[A-Za-z0-9-]+$)", dot)

    number = F.concat(F.lit(" "), other)
    word = F.coalesce(F.nullif(F.regexp_extract(left, r"([A-Za-z]+)[^A-Za-z]*$", 1), F.lit("")), F.lit("look"))
    three = F.concat(F.substring(other, 1, 3), F.lit(" "))
    return (
        F.when(
            kind == "card",
            F.array(
                variant("", body, "", 1),
                variant("", fours(" ", digits), "", 1),
                variant("", fours("-", digits), "", 1),
                variant(three, digits, "", 1),
                variant(F.concat(F.substring(other, 1, 3), F.lit("-"), F.substring(other, 4, 4), F.lit(" ")), digits, "", 1),
                variant("", digits, F.concat(F.lit(" "), F.substring(other, 1, 4)), 1),
                variant("", wrong, "", 0),
                variant("", fours(" ", wrong), "", 0),
                variant(three, wrong, "", 0),
                variant("a", digits, "b", 0),
            ),
        )
        .when(
            kind == "phone",
            F.array(
                variant("", body, "", 1),
                variant("", body, number, 1),
                variant("", body, F.concat(F.lit(" "), F.substring(other, 1, 4), F.lit(" "), F.substring(other, 5, 4)), 1),
                variant("", parts("(", ") ", "-"), "", 1),
                variant("", parts("", "-", "-"), "", 1),
                variant("", parts("", ".", "."), "", 1),
                variant("", digits, "", 0),
                variant("", F.substring(local, 1, 7), "", 0),
                variant("a", digits, "b", 0),
            ),
        )
        .when(
            kind == "ip",
            F.array(
                variant("", body, "", 1),
                variant("", body, number, 1),
                variant("", F.regexp_replace(body, r"^[0-9]+", "999"), "", 0),
                variant(F.concat(F.substring(other, 1, 1), F.lit(".")), body, "", 0),
                variant("", body, F.concat(F.lit("."), F.substring(other, 1, 2)), 0),
            ),
        )
        .otherwise(
            F.array(
                variant("", spelled(" at ", " dot "), "", 1),
                variant("", spelled("(at)", "."), "", 1),
                variant("", spelled(" [at] ", " [dot] "), "", 1),
                variant("", spelled(" @ ", "."), "", 1),
                variant("", F.concat(word, F.regexp_replace(body, r"^.*@", " at ")), "", 0),
                variant("", F.concat(word, F.regexp_replace(body, r"^.*@[^.]*", " at www")), "", 0),
            )
        )
    )


def examples(docs: DataFrame, text: str, least: int = FIT_DOCUMENTS) -> DataFrame:
    """Labelled candidates ``(kind, x, y, fold)`` from about ``least`` documents that a hash of their text selects.

    Right ones are the candidates that equal a fixed pattern's span or a rewriting of it, in the span's own
    surroundings; wrong ones all other candidates there, and those of documents without any
    match. All that comes from one value is in one fold.
    """
    number = docs.count()
    share = min(1.0, least / max(number, 1))
    body = F.coalesce(F.col(text), F.lit("")).alias("__text")
    sample = docs.select(body).where(F.pmod(F.xxhash64("__text"), F.lit(1 << 30)) < share * (1 << 30))
    sample = with_generators(fixed_spans(sample.distinct(), "__text"), "__text")
    sample = materialize(sample.drop("__text"), "pii-sample")

    values = sample.select(F.explode(F.concat(*[_named(k) for k in KINDS])).alias("s")).select("s.*")
    values = values.withColumn("v", F.explode(_rewritten(F.col("kind"), F.col("body"), F.col("left"))))
    place = F.length("left") + F.length("v.before")
    snippets = values.select(
        F.pmod(F.xxhash64("body"), F.lit(FOLDS)).alias("fold"),
        F.col("kind").alias("true_kind"),
        place.alias("true_start"),
        (place + F.length("v.body")).alias("true_end"),
        F.col("v.good").alias("good"),
        F.concat("left", "v.before", "v.body", "v.after", "right").alias("__text"),
    )
    names = ["fold", "true_kind", "true_start", "true_end", "good"]
    near = candidates(with_generators(snippets, "__text"), names)
    same = (F.col("kind") == F.col("true_kind")) & (F.col("start") == F.col("true_start")) & (F.col("end") == F.col("true_end"))
    touches = (F.col("start") < F.col("true_end")) & (F.col("end") > F.col("true_start"))
    # other candidates of the surroundings may be other people's data, so they are no examples
    near = near.where(touches).select("kind", "x", (same & (F.col("good") == 1)).cast("int").alias("y"), "fold")

    plain = sample.where(~F.col("doubt") & (F.size("email") == 0))
    far = candidates(plain.withColumn("fold", F.pmod(F.xxhash64("__groups", "__spelled"), F.lit(FOLDS))), ["fold"])
    return near.unionByName(far.select("kind", "x", F.lit(0).alias("y"), "fold"))


def fit(docs: DataFrame, text: str, least: int = FIT_DOCUMENTS, precision: float = PRECISION) -> Trees:
    """Trees and thresholds from ``docs`` themselves. Without any fixed span nothing is learned, and nothing added."""
    rows = materialize(examples(docs, text, least), "pii-labelled")
    trees = grown(rows.where("fold <> 0"))
    return calibrate(trees, rows.where("fold = 0"), precision)


def selected(rows: DataFrame, trees: Trees, keep: list[str]) -> DataFrame:
    """``keep``, kind, start, end of the candidates above their threshold that no better one overlaps.

    A candidate stays if, of all selected candidates and fixed spans of its kind on each of its cells, it
    is the best: fixed spans come first, then the higher probability, the longer span, the earlier start.
    """
    if not trees.threshold:
        return rows.select(*keep, F.lit("").alias("kind"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end")).limit(0)
    at_least = F.lit(2.0)
    for kind, least in trees.threshold.items():
        at_least = F.when(F.col("kind") == kind, least).otherwise(at_least)
    found = materialize(candidates(rows, keep), "pii-candidates")  # else each tree would compute the features anew
    found = found.withColumn("p", trees.probability()).where(F.col("p") >= at_least)
    fixed = F.concat(*[_named(k) for k in KINDS[1:]])
    fixed = rows.select(*keep, F.explode(fixed).alias("s")).select(*keep, "s.kind", "s.start", "s.end", "s.body")
    fixed = _matched(fixed, "body", "groups", "[0-9]++", F.lit(True))
    fixed = fixed.select(
        *keep, "kind", "start", "end", F.transform("groups", lambda g: F.col("start") + g["start"]).alias("cells"), F.lit(9.0).alias("p")
    )
    both = found.select(*fixed.columns).unionByName(fixed)
    rank = F.struct(F.col("p").alias("p"), (F.col("end") - F.col("start")).alias("length"), (-F.col("start")).alias("early"))
    cells = both.select("*", rank.alias("rank"), F.explode("cells").alias("cell"))
    top = F.max("rank").over(Window.partitionBy(*keep, "kind", "cell"))
    cells = cells.withColumn("wins", F.col("rank") == top)
    kept = cells.groupBy(*keep, "kind", "start", "end", "p").agg(F.every("wins").alias("wins"))
    return kept.where("wins and p < 9").select(*keep, "kind", "start", "end")


def scanned(docs: DataFrame, text: str, trees: Trees | None = None, keep: list[str] | None = None) -> DataFrame:
    """``keep``, the fixed spans per kind and ``added`` (kind, start, end) of every row of ``docs``.

    NULL texts count as empty; empty texts have no spans. Repeated rows each get their own result. The
    whole text is searched, once; its spans and groups of digits are written to the shared folder.
    """
    keep = keep or []
    trees = fit(docs, text) if trees is None else trees
    docs = located(docs).select(FILE, PLACE, *[F.col(c).alias(f"__keep_{c}") for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    rows = with_generators(fixed_spans(docs, "__text"), "__text").drop("__text", "doubt")
    rows = materialize(rows, "pii-spans")
    added = selected(rows, trees, [FILE, PLACE]).groupBy(FILE, PLACE).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    rows = rows.select(FILE, PLACE, *[F.col(f"__keep_{c}").alias(c) for c in keep], *KINDS).join(added, [FILE, PLACE], "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.select(*keep, *KINDS, F.coalesce("added", none).alias("added"))


def digest(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts, SHA-256 of the fixed spans and the list of all spans, from ``scanned``."""
    name = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    named = lambda k: F.transform(k, lambda s: name(F.lit(k), s))
    fixed = F.concat(*[named(k) for k in KINDS])
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    flat = lambda k: F.transform(k, lambda s: F.struct(F.lit(KINDS.index(k)).alias("at"), s["start"], s["end"], F.lit(k).alias("kind")))
    added = F.transform("added", lambda s: F.struct(order[s["kind"]].alias("at"), s["start"], s["end"], s["kind"]))
    every = F.array_sort(F.concat(*[flat(k) for k in KINDS], added))
    return found.select(
        *keep,
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", fixed), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(every, lambda s: name(s["kind"], s))).alias("spans"),
    )

