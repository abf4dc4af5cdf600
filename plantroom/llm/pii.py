"""Personal data by candidate gradient boosting, with built-in functions only.

Patterns of high recall propose spans that may overlap. Each proposal is described by a few small numbers, taken from
its format and from the characters around it. Boosted trees, fitted to the counts of all proposals of the corpus by
these numbers, give a score, and a threshold for each kind, calibrated on documents the trees have not seen, selects
what is redacted beside the spans that the base patterns and checks find for certain.

A proposal is labelled by what the trees do not see: the check of its kind (the Luhn sum, a leading plus, the literal
pattern) and the words before it. So they learn from the rest of the format, and can select what no check confirms.

The trees need only the counts: there are no more combinations than the numbers have values, whatever the corpus holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantroom.llm.shared import stored

#: Columns of our own, named so that they meet none of the documents'.
ROW, SPANS, MASKED = "_pii_row", "_pii_spans", "_pii_masked"

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns. Possessive quantifiers match the same texts as plain ones here, without recursion; the look-behind
# keeps a long run from being tried at each of its characters, and \G lets a match follow the last one at once.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?=\.|\z))"

# Proposals of high recall.
_MAIL_LIKE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+(?:\(at\)|\[at\]|@)\x20?+[A-Za-z0-9-]++"
    r"(?:\x20?+(?:(?:\(dot\)|\[dot\])\x20?+|\.)[A-Za-z0-9-]++)++"
)
_NUMBER_LIKE = r"\+?+\(?+[0-9](?:[\x20().-]{0,3}+[0-9]){6,}+"
_PHONE_LIKE = r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]{0,2}[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"
_CARD_LIKE = r"(?<![0-9])(?:[0-9]{4}[\x20.-]?){3}[0-9]{2,7}(?![0-9])"
_KEY_LIKE = r"(?:\G|(?<![A-Za-z0-9_/+=-]))(?=[A-Za-z_/+=-]*+[0-9])[A-Za-z0-9_/+=-]{16,}+"

#: Words before a proposal that name its kind.
_NAMED = {
    "email": r"mail|contact|write|@",
    "ip": r"ip|host|address|server",
    "card": r"card|visa|credit|pay|account",
    "phone": r"phone|tel|call|fax|mobile",
    "secret": r"password|passwd|pwd|secret|token|key",
}

#: The numbers that describe a proposal, with how many values each has.
FEATURES = {"digits": 7, "letters": 4, "marks": 3, "plus": 2, "bracket": 2, "valid": 2, "grouped": 2, "named": 2, "edge": 2}

#: Of these, what takes part in the label of a kind and is hidden from its trees.
HIDDEN = {"email": {"grouped", "bracket", "named"}, "card": {"valid", "named"}, "phone": {"plus", "valid", "named"}, "secret": {"named"}}

ROUNDS, RATE, LEAST_PRECISION = 24, 0.4, 0.9


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` over a value that is computed once, however often `use` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _accumulate(values: Column) -> Column:
    grown = F.aggregate(values, F.array(F.lit(0)), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))
    return F.slice(grown, F.lit(2), F.size(values))


def running_sums(values: Column, block: int = 256) -> Column:
    """Inclusive running sums of a non-empty array, in blocks: thousands of values stay cheap."""
    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
    blocks = F.transform(starts, lambda b: _accumulate(F.slice(values, b * block + 1, F.lit(block))))

    def joined(blocks: Column) -> Column:
        totals = F.concat(F.array(F.lit(0)), _accumulate(F.transform(blocks, lambda b: F.element_at(b, -1))))
        offsets = F.slice(totals, F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b, lambda v: v + o)))

    return let(blocks, joined)


def matches(text: Column, pattern: str) -> Column:
    """All matches with their places: array of (start, end, found), in code points, end exclusive."""

    def placed(x: Column) -> Column:
        lengths = F.zip_with(x["gaps"], x["found"], lambda g, f: F.length(g) + F.coalesce(F.length(f), F.lit(0)))
        ends = let(lengths, lambda n: F.slice(running_sums(n), F.lit(1), F.size(x["found"])))
        return F.zip_with(
            x["found"], ends, lambda f, e: F.struct((e - F.length(f)).alias("start"), e.alias("end"), f.alias("found"))
        )

    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(pieces, placed)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        value = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = value * 2
        return total + F.when(i % 2 == 0, value).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def is_card(found: Column) -> Column:
    return let(_digits(found), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))


def is_phone(found: Column) -> Column:
    return F.length(_digits(found)).between(10, 15)


def is_ip(found: Column) -> Column:
    return F.rlike(found, F.lit(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"))


def _bin(value: Column, *limits: int) -> Column:
    chosen = F.lit(len(limits))
    for place, limit in reversed(list(enumerate(limits))):
        chosen = F.when(value < limit, place).otherwise(chosen)
    return chosen


def _described(kind: str, base: bool, text: Column, span: Column) -> Column:
    """A span with its kind, numbers and label; base spans carry no numbers."""
    found, start, end = span["found"], span["start"], span["end"]
    if base:
        zero = F.lit(0)
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.lit(True).alias("base"), F.lit(False).alias("label"), F.lit(False).alias("sure"),
            *[zero.alias(name) for name in FEATURES],
        )
    digits, letters = F.length(_digits(found)), F.length(F.regexp_replace(found, "[^A-Za-z]", ""))
    plain = "A-Za-z0-9+" if kind == "phone" else "A-Za-z0-9"  # a plus is part of the label of phones
    marks = F.size(F.array_distinct(F.split(F.regexp_replace(found, f"[{plain}]", ""), "")))
    marks = F.when(F.rlike(found, F.lit(f"[^{plain}]")), marks).otherwise(0)
    before = F.lower(F.substr(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24))))
    around = F.concat(F.substr(text, start, F.when(start > 0, 1).otherwise(0)), F.substr(text, end + 1, F.lit(1)))
    named = F.rlike(before, F.lit(_NAMED[kind]))
    checks = {
        "email": F.rlike(found, F.lit(r"(?:\.|dot[\])]\x20?)[a-z]{2,12}\z")),
        "card": is_card(found),
        "phone": is_phone(found),
        "secret": F.rlike(found, F.lit("[A-Za-z]")) & F.rlike(found, F.lit("[0-9].*[0-9].*[0-9]")),
    }
    grouped = {
        "email": r"\A[^ ]+\z",
        "card": r"\A(?:[0-9]{4}[ .-]?){3}[0-9]{4}\z",
        "phone": r"\A(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]{0,2}[0-9]{3}[ .-]?[0-9]{4}\z",
        "secret": r"\A(?:[0-9a-f]+|[A-Z0-9]+|[a-z]+=[0-9a-f]+)\z",
    }
    # what the check of a kind confirms by itself, and what the words before name
    sure = {
        "email": F.rlike(found, F.lit(_EMAIL)),
        "card": checks["card"],
        "phone": F.rlike(found, F.lit(r"\A\+[0-9]")) & checks["phone"],
        "secret": F.lit(False),
    }
    labels = {
        "email": sure["email"] | named,
        "card": sure["card"] | (named & digits.between(14, 19)),
        "phone": sure["phone"] | (named & checks["phone"]),
        "secret": named | F.rlike(found, F.lit(r"\AAKIA|(?i)password=|token=|secret=")),
    }
    flag = lambda c: c.cast("int")
    numbers = {
        "digits": _bin(digits, 7, 10, 12, 14, 17, 20),
        "letters": _bin(letters * 100 / F.length(found), 1, 25, 60),
        "marks": _bin(marks, 1, 2),
        "plus": flag(F.startswith(found, F.lit("+"))),
        "bracket": flag(F.rlike(found, F.lit(r"[(\[]"))),
        "valid": flag(checks[kind]),
        "grouped": flag(F.rlike(found, F.lit(grouped[kind]))),
        "named": flag(named),
        "edge": flag(F.rlike(around, F.lit("[A-Za-z0-9]"))),
    }
    return F.struct(
        F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.lit(False).alias("base"),
        F.coalesce(labels[kind], F.lit(False)).alias("label"), F.coalesce(sure[kind], F.lit(False)).alias("sure"),
        *[(F.lit(0) if name in HIDDEN[kind] else F.coalesce(numbers[name], F.lit(0))).alias(name) for name in FEATURES],
    )


def proposals(text: Column) -> Column:
    """All spans of a text, certain ones and proposals, as an array. Null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    none = F.slice(F.array(_described("ip", True, F.lit(""), F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("found")))), F.lit(1), F.lit(0))

    def taken(kind: str, pattern: str, base: bool, worth: Column, check=None) -> Column:
        found = matches(text, pattern)
        found = F.filter(found, lambda s: check(s["found"])) if check else found
        return F.when(worth, F.transform(found, lambda s: _described(kind, base, text, s))).otherwise(none)

    at = F.contains(text, F.lit("@"))
    digit = F.rlike(text, F.lit("[0-9]"))
    plus = F.rlike(text, F.lit(r"\+[0-9]"))
    dotted = F.rlike(text, F.lit(r"[0-9]\.[0-9]"))
    many = F.rlike(text, F.lit(r"[0-9](?:[\x20().-]{0,3}+[0-9]){6}"))
    return F.concat(
        taken("email", _EMAIL, True, at),
        taken("ip", _IP, True, dotted, is_ip),
        taken("card", _CARD, True, many, is_card),
        taken("phone", _PHONE, True, plus, is_phone),
        taken("email", _MAIL_LIKE, False, at | F.rlike(text, F.lit(r"[(\[]at[)\]]"))),
        taken("phone", _NUMBER_LIKE, False, many),
        taken("phone", _PHONE_LIKE, False, many),
        taken("card", _NUMBER_LIKE, False, many),
        taken("card", _CARD_LIKE, False, many),
        taken("secret", _KEY_LIKE, False, digit),
    )


# ------------------------------------------------------------------------------------------------- boosted trees


def _gain(cells: list[dict], value: Callable[[dict], bool]) -> tuple[float, list[dict], list[dict]]:
    parts: tuple[list, list] = ([], [])
    for cell in cells:
        parts[value(cell)].append(cell)
    sums = [(sum(c["gradient"] for c in p), sum(c["curvature"] for c in p)) for p in parts]
    return sum(g * g / (h + 1.0) for g, h in sums), parts[0], parts[1]


def _leaf(cells: list[dict]) -> float:
    return RATE * sum(c["gradient"] for c in cells) / (sum(c["curvature"] for c in cells) + 1.0)


def _grow(cells: list[dict], depth: int):
    """A tree: a leaf's value, or (feature, limit, tree below the limit, tree at or above it)."""
    total = sum(c["gradient"] for c in cells) ** 2 / (sum(c["curvature"] for c in cells) + 1.0)
    best = (total + 1e-9, None)
    for name, values in FEATURES.items() if depth else ():
        for limit in range(1, values):
            gain, low, high = _gain(cells, lambda c: c[name] >= limit)  # noqa: B023
            if low and high and gain > best[0]:
                best = (gain, (name, limit, low, high))
    if best[1] is None:
        return _leaf(cells)
    name, limit, low, high = best[1]
    return (name, limit, _grow(low, depth - 1), _grow(high, depth - 1))


def _value(tree, cell) -> float:
    while isinstance(tree, tuple):
        tree = tree[3] if cell[tree[0]] >= tree[1] else tree[2]
    return tree


def boost(cells: list[dict], rounds: int = ROUNDS, depth: int = 3) -> list:
    """Trees for the log-odds of the label, from cells with `n` proposals of which `hits` have it."""
    scores = [0.0] * len(cells)
    trees = []
    for _ in range(rounds if cells else 0):
        for cell, score in zip(cells, scores, strict=True):
            p = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, score))))
            cell["gradient"], cell["curvature"] = cell["hits"] - cell["n"] * p, cell["n"] * p * (1.0 - p)
        tree = _grow(cells, depth)
        trees.append(tree)
        scores = [s + _value(tree, c) for s, c in zip(scores, cells, strict=True)]
    return trees


def calibrate(trees: list, cells: list[dict], precision: float = LEAST_PRECISION) -> float:
    """The lowest score at which, among cells the trees have not seen, at least `precision` have the label.

    Scores are pooled with lower ones only where these have the label as often (isotonic regression), so no score is
    accepted for what others above it have to spare.
    """
    blocks: list[list] = []
    for score, n, hits in sorted((sum(_value(t, c) for t in trees), c["n"], c["hits"]) for c in cells):
        block = [score, n, hits, score]
        while blocks and (blocks[-1][3] == block[0] or blocks[-1][2] * block[1] >= block[2] * blocks[-1][1]):
            low, more, good, _ = blocks.pop()
            block = [low, more + block[1], good + block[2], block[3]]
        blocks.append(block)
    return min((b[0] for b in blocks if (b[2] + 0.5) / (b[1] + 1.0) >= precision), default=math.inf)


def refused(cells: list[dict], precision: float = LEAST_PRECISION) -> set[int]:
    """Combinations of the numbers, by `_place`, whose own proposals have the label too rarely, whatever their score."""
    counts: dict[int, list[int]] = {}
    for cell in cells:
        own = counts.setdefault(_place(cell.__getitem__), [0, 0])
        own[0], own[1] = own[0] + cell["n"], own[1] + cell["hits"]
    return {place for place, (n, hits) in counts.items() if hits < precision * n}


def _place(value: Callable):
    """A combination of the numbers as one."""
    place = 0
    for name, values in FEATURES.items():
        place = place * values + value(name)
    return place


def _tree_column(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, limit, low, high = tree
    return F.when(F.col(name) >= limit, _tree_column(high)).otherwise(_tree_column(low))


def fit(spans: DataFrame) -> dict[str, tuple[list, float, set[int]]]:
    """Trees, threshold and refused combinations by kind, from exploded spans with `fold`; only counts by combination reach the driver."""
    counts = (
        spans.where(~F.col("base"))
        .groupBy("kind", "fold", *FEATURES)
        .agg(F.count("*").alias("n"), F.count(F.when(F.col("label"), 1)).alias("hits"))
        .collect()
    )
    models = {}
    for kind in KINDS:
        cells = sorted((r.asDict() for r in counts if r["kind"] == kind), key=lambda c: [c[x] for x in ("fold", *FEATURES)])
        trees = boost([c for c in cells if c["fold"] == 0])
        threshold = calibrate(trees, [c for c in cells if c["fold"] == 1])
        high = [c for c in cells if sum(_value(t, c) for t in trees) >= threshold - 1e-4]
        models[kind] = (trees, threshold, refused(high))
    return models


def _selected(models: dict[str, tuple[list, float, set[int]]]) -> tuple[Column, Column]:
    """Score of a proposal, and whether its kind's threshold selects it."""
    score, chosen = F.lit(0.0), F.lit(False)
    for kind, (trees, threshold, bad) in models.items():
        if not trees or threshold == math.inf:
            continue
        total = F.lit(0.0)
        for tree in trees:
            total = total + _tree_column(tree)
        score = F.when(F.col("kind") == kind, total).otherwise(score)
        chosen = F.when(F.col("kind") == kind, (F.col("score") >= threshold - 1e-5) & ~_place(F.col).isin(sorted(bad))).otherwise(chosen)
    return score, chosen


# ------------------------------------------------------------------------------------------------- operators


def located(documents: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Documents with an own number (ROW) and all proposals of their texts (SPANS), and the selected spans.

    The spans (ROW, kind, start, end, base): every base span, and each proposal that the check of its kind confirms or
    the trees select, if it overlaps no base span of its kind and no better proposal of its kind. Spans of one document are compared in order of their starts.
    """
    table = stored(
        documents.withColumn(ROW, F.monotonically_increasing_id()).withColumn(SPANS, proposals(F.col(text))), "pii"
    )
    fold = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 0
    rows = table.where(F.size(SPANS) > 0).select(ROW, fold.cast("int").alias("fold"), F.explode(SPANS).alias("s"))
    rows = rows.select(ROW, "fold", "s.*")
    score, chosen = _selected(fit(rows))
    spans = rows.withColumn("score", F.round(score, 6)).where(F.col("base") | F.col("sure") | chosen).drop(*FEATURES, "fold", "label")
    spans = spans.dropDuplicates([ROW, "kind", "start", "end", "base"])
    by_start = Window.partitionBy(ROW, "kind").orderBy("start", "end", F.desc("base"))
    ahead, behind = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    certain = lambda c: F.when(F.col("base"), F.col(c))
    spans = spans.withColumn(
        "free",
        F.col("base")
        | (
            (F.coalesce(F.max(certain("end")).over(ahead), F.lit(-1)) <= F.col("start"))
            & (F.coalesce(F.min(certain("start")).over(behind), F.lit(2**31 - 1)) >= F.col("end"))
        ),
    )
    spans = spans.where("free")
    # groups of proposals that overlap one another; the best of a group stands for it
    starts_group = F.coalesce(F.max("end").over(ahead) <= F.col("start"), F.lit(True))
    spans = spans.withColumn("group", F.sum(starts_group.cast("int")).over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy(ROW, "kind", "group").orderBy(F.desc("sure"), F.desc("score"), F.desc(F.col("end") - F.col("start")), "start", "end")
    spans = spans.withColumn("place", F.when(F.col("base"), 1).otherwise(F.row_number().over(best))).where("place = 1")
    return table, spans.select(ROW, "kind", "start", "end", "base")


def _listing(chosen: Column) -> Column:
    ordered = F.array_sort(F.collect_list(F.when(chosen, F.struct("start", "place", "end", "kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(documents: DataFrame) -> DataFrame:
    """Personal data of every document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_selected.

    One row for each row of the input, repeated and null ids included. Null and empty texts have no spans. `spans`
    lists all spans, `base_sha256` digests those that patterns and checks alone find, both as kind:start:end in the
    order of start, then kind. Further columns are ignored.
    """
    table, spans = located(documents.select("doc_id", "text"))
    order = F.array_position(F.array([F.lit(k) for k in KINDS]), F.col("kind"))
    found = (
        spans.withColumn("place", order)
        .groupBy(ROW)
        .agg(
            *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE_KINDS],
            F.sha2(_listing(F.col("base")), 256).alias("base_sha256"),
            _listing(F.lit(True)).alias("spans"),
            F.count(F.when(~F.col("base"), 1)).alias("n_selected"),
        )
    )
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return table.select(ROW, "doc_id").join(found, ROW, "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.coalesce("base_sha256", empty).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_selected", F.lit(0)).cast("long").alias("n_selected"),
    )


def mask(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with every selected span replaced by its kind in brackets; the same columns.

    Spans that overlap become one, named after the first. Texts without spans stay as they are, null included; a
    column n_chars, if there is one, follows the new text.
    """
    names = documents.columns
    table, spans = located(documents, text, key)
    by_start = Window.partitionBy(ROW).orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce(reach <= F.col("start"), F.lit(True)).cast("int"))
    spans = spans.withColumn("group", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = (
        spans.groupBy(ROW, "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind"))
        .withColumn("since", F.coalesce(F.lag("end").over(Window.partitionBy(ROW).orderBy("start")), F.lit(0)))
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "since"))).alias(MASKED))
    )
    pieces = F.transform(
        MASKED,
        lambda m: F.concat(F.substr(F.col(text), m["since"] + 1, m["start"] - m["since"]), F.lit("["), F.upper(m["kind"]), F.lit("]")),
    )
    rest = F.substr(F.col(text), F.element_at(MASKED, -1)["end"] + 1)
    touched = table.where(F.size(SPANS) > 0).join(merged, ROW, "left")
    is_masked = F.col(MASKED).isNotNull()
    new_text = F.when(is_masked, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col(text))
    touched = touched.withColumn(text, new_text)
    if "n_chars" in names:
        size = F.length(text).cast(documents.schema["n_chars"].dataType)
        touched = touched.withColumn("n_chars", F.when(is_masked, size).otherwise(F.col("n_chars")))
    return touched.select(*names).unionByName(table.where(F.size(SPANS) == 0).select(*names))
