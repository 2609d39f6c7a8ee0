"""Personal data by candidates and boosted trees, in SQL expressions only.

Base spans are the matches of four fixed patterns that pass their checks. Wider generators propose more, overlapping
each other: obfuscated addresses, national phone numbers, dotted card numbers, defanged and IPv6 hosts. Boosted trees judge
each candidate by its format and its surroundings and become one CASE expression, so that scoring runs
where the text is read: no shuffle, no Python. The trees learn on all texts. What they are taught as right is all base
spans, disguised on purpose in their own surroundings; as wrong, what the generators propose beyond the base, and strings
of the same shapes that are no personal data. Candidates of equal features are counted before the trees see them, so what
they learn on grows with the number of forms and not of texts. A threshold a kind, set on spans the trees didn't
see, selects what is added.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The base patterns. A run of characters is entered only at its start (or where the last match ended),
# which finds the same matches as trying every place and keeps long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Proposals beyond the base, by kind. Every match has a bounded length.
_AT, _DOT = r"\x20?(?:\(at\)|\[at\]|\{at\}|@)\x20?|\x20at\x20", r"\x20?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\])\x20?|\x20dot\x20|\."
PROPOSALS = {
    "email": rf"(?i)(?<![a-z0-9._-])[a-z0-9][a-z0-9_-]{{0,63}}+(?:(?:{_DOT})[a-z0-9_-]{{1,63}}){{0,3}}(?:{_AT})[a-z0-9-]{{1,63}}(?:(?:{_DOT})[a-z0-9-]{{2,24}}){{1,4}}(?![a-z0-9])",
    "ip": r"(?i)(?<![0-9a-f:.])(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3})(?![0-9a-f:])",
    "card": r"(?<![0-9.])[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}[./_][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20./-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
# No match of a generator is longer, and none shorter, than this; so many others it may touch.
_LONGEST, _SHORTEST = 700, 6
FEATURES = (
    "kind", "length", "digits", "separators", "brackets", "dots", "ats", "words", "before", "after", "cue", "other", "sum10", "octets", "domain",
)
_CUE = r"(?i)\b(tel|phone|fon|call|fax|mobil|sms|mail|contact|kontakt|card|visa|pay|host|addr|server|write|reach)\W{0,3}\w{0,8}\W{0,3}$"
_OTHER = r"(?i)(?:\b(?:isbn|order|item|part|invoice|ref|no|nr|sku|version|ver|v|id|lot|total|page)|#|\$|€)[\W_]{0,3}$"
# The most common ends of host names.
_ENDS = r"(?i)(?:com|org|net|edu|gov|mil|info|biz|io|app|dev|tv|eu|de|fr|nl|pl|ru|uk|ca|au|ch|se|dk|cz|pt|br|jp|cn|test|example)$"
# The share of right ones among added candidates.
PRECISION = 0.9


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often and in whatever lambda ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, start: Column, merge) -> Column:
    """``merge`` of the elements before each element; blocks of 64 keep long arrays from quadratic work."""

    def with_blocks(each: Column):
        def places(blocks: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.size(each) - 1),
                lambda i: merge(
                    F.aggregate(F.slice(blocks, F.lit(1), F.floor(i / 64).cast("int")), start, merge),
                    F.aggregate(F.slice(each, F.floor(i / 64).cast("int") * 64 + 1, i % 64), start, merge),
                ),
            )

        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(each) - 1) / 64).cast("int")),
            lambda b: F.aggregate(F.slice(each, b * 64 + 1, F.lit(64)), start, merge),
        )
        return _let(blocks, places)

    return _let(values, with_blocks)


def _sums(lengths: Column) -> Column:
    return _before(lengths, F.lit(0), lambda a, x: a + x)


def _found(text: str, name: str, pattern: str, gate: str, context: bool = False) -> tuple[Column, Column]:
    """Matches of a pattern, and their spans as ``(kind, start, end, match)`` in code points.

    With ``context`` a span also has up to 24 characters before it and one after it, as far as the next match.
    """
    kind = KINDS.index(name)
    literal = F.lit(pattern)
    matches = F.when(F.col(text).rlike(gate), F.regexp_extract_all(text, literal, F.lit(0))).otherwise(F.array().cast("array<string>"))

    def spans(m: Column) -> Column:
        # Gap, match, gap, match ...: a match starts where all before it ends.
        def placed(between: Column) -> Column:
            gaps = F.transform(F.slice(between, F.lit(1), F.size(m)), F.char_length)

            def with_starts(starts: Column) -> Column:
                def one(s: Column, i: Column) -> Column:
                    fields = [F.lit(kind).alias("kind"), F.get(starts, i).alias("start"), (F.get(starts, i) + F.char_length(s)).alias("end"), s.alias("match")]
                    if context:
                        fields += [F.substring(F.get(between, i), -24, 24).alias("lead"), F.substring(F.get(between, i + 1), 1, 24).alias("rest")]
                    return F.struct(*fields)

                return F.transform(m, one)

            def with_gaps(g: Column) -> Column:
                sums = _sums(F.zip_with(g, m, lambda gap, s: gap + F.char_length(s)))
                return _let(F.zip_with(sums, g, lambda before, gap: before + gap), with_starts)

            return _let(gaps, with_gaps)

        kinds = "array<struct<kind:int,start:int,end:int,match:string" + (",lead:string,rest:string>>" if context else ">>")
        return F.when(F.size(m) == 0, F.array().cast(kinds)).otherwise(_let(F.split(F.col(text), pattern, -1), placed))

    return matches, spans


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    digits = F.reverse(_digits(s))
    doubled = lambda i: (F.substring(digits, i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)), F.lit(0),
        lambda a, i: a + doubled(i) - F.when(doubled(i) > 9, 9).otherwise(0),
    )
    return F.when(digits == "", 0).otherwise(total)


def _valid(name: str, s: Column) -> Column:
    n = F.char_length(_digits(s))
    return {
        "email": F.lit(True),
        "ip": s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": n.between(13, 19) & (_luhn(s) % 10 == 0),
        "phone": n.between(9, 15),
    }[name]


def _checks(name: str):
    return lambda x: _valid(name, x["match"])


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


# A text that doesn't match the gate can't match the pattern; gates are cheap.
_GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_OPEN = {
    "email": r"(?:[(\[{][aA][tT][)\]}]\x20?|\x20[aA][tT]\x20|@\x20?)[A-Za-z0-9-]{1,63}(?:\x20?[(\[{]|\x20[dD][oO][tT]\x20|\.[A-Za-z0-9-]{2})", "ip": r"(?i)[0-9a-f]:[0-9a-f]{1,4}:|[0-9]\x20?[\[(](?:\.|dot)[\])]", "card": "[0-9]{4}[./_][0-9]{4}",
    "phone": r"[0-9]{3}\)?[\x20./-]?[0-9]{3}[\x20.-][0-9]{4}",
}


def _with_base(docs: DataFrame, text: str, context: bool = False) -> DataFrame:
    """``docs`` with ``base``: the valid base spans by kind, then start."""
    for name in KINDS:
        matches, spans = _found(text, name, PATTERNS[name], _GATES[name], context)
        docs = docs.withColumn(f"m_{name}", matches)
        docs = docs.withColumn(f"s_{name}", F.filter(spans(F.col(f"m_{name}")), _checks(name)))
    return docs.withColumn("base", F.concat(*[f"s_{k}" for k in KINDS])).drop(*[f"{p}_{k}" for k in KINDS for p in "ms"])


def _with_proposals(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``proposed``: spans of the wider generators that touch no span of ``base``, and their features."""
    for name in KINDS:
        matches, spans = _found(text, name, PROPOSALS[name], _OPEN[name], True)
        docs = docs.withColumn(f"m_{name}", matches).withColumn(f"s_{name}", spans(F.col(f"m_{name}")))
    docs = docs.withColumn("wide", F.concat(*[f"s_{k}" for k in KINDS])).drop(*[f"{p}_{k}" for k in KINDS for p in "ms"])
    docs = docs.withColumn("wide", _free("base", "wide"))

    def features(c: Column) -> Column:
        s = c["match"]
        count = lambda chars: (F.char_length(s) - F.char_length(F.regexp_replace(s, chars, ""))).cast("double")
        yes = lambda test: F.when(test, 1.0).otherwise(0.0)
        lead = c["lead"]
        before, after = F.substring(lead, -1, 1), F.substring(c["rest"], 1, 1)
        cls = lambda x: F.when(x == "", 0.0).when(x.rlike(r"\s"), 1.0).when(x.rlike("[0-9]"), 2.0).when(x.rlike(r"\p{L}"), 3.0).otherwise(4.0)
        parts = F.split(s, "[^0-9]+", -1)
        values = {
            "kind": c["kind"].cast("double"), "length": F.char_length(s).cast("double"), "digits": count("[0-9]"),
            "separators": count(r"[\x20-]"), "brackets": count(r"[()\[\]{}]"), "dots": count(r"\."), "ats": count("@"),
            "words": F.when(c["kind"] == 0, F.size(F.split(s, r"(?i)\x20(?:at|dot)\x20", -1)) - 1.0).otherwise(0.0),
            "before": cls(before), "after": cls(after), "cue": yes(lead.rlike(_CUE)), "other": yes(lead.rlike(_OTHER)),
            "sum10": (_luhn(F.when(c["kind"] == 2, s).otherwise("")) % 10).cast("double"),
            "octets": yes((c["kind"] == 1) & F.forall(parts, lambda x: F.char_length(x).between(1, 3) & (F.concat(F.lit("0"), x).try_cast("int") <= 255))),
            "domain": yes((c["kind"] == 0) & s.rlike(_ENDS)),
        }
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), *[values[f].alias(f"f_{f}") for f in FEATURES])

    return docs.withColumn("proposed", F.transform("wide", features)).drop("wide")


def _free(base: str, proposed: str) -> Column:
    """Proposals that touch no base span.

    Starts of base spans and ends of proposals are put in one order: a proposal is touched if the furthest end of the base
    spans that start before its end lies beyond its start.
    """

    def untouched(bases: Column, spans: Column) -> Column:
        events = F.array_sort(
            F.concat(
                F.transform(bases, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("base"), b["end"].alias("reach"), F.lit(-1).alias("place"))),
                F.transform(spans, lambda c, i: F.struct(c["end"].alias("at"), F.lit(0).alias("base"), F.lit(-1).alias("reach"), i.alias("place"))),
            )
        )

        def chosen(e: Column) -> Column:
            furthest = _before(F.transform(e, lambda x: x["reach"]), F.lit(-1), lambda a, x: F.greatest(a, x))
            marked = F.zip_with(e, furthest, lambda x, reach: F.struct(x["place"].alias("place"), reach.alias("reach")))
            kept = F.filter(marked, lambda x: (x["place"] >= 0) & (x["reach"] <= F.get(spans, x["place"])["start"]))
            return F.transform(kept, lambda x: F.get(spans, x["place"]))

        return _let(events, chosen)

    with_both = _let(F.col(base), lambda b: _let(F.col(proposed), lambda p: untouched(b, p)))
    return F.when((F.size(base) == 0) | (F.size(proposed) == 0), F.col(proposed)).otherwise(with_both)


def _case(tree: str) -> str:
    """A tree's printed form as nested CASE expressions over ``c.f_<feature>``."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in tree.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(at: int) -> tuple[str, int]:
        line = lines[at][1]
        if line.startswith("Predict"):
            return f"{float(line.split(':')[1])!r}D", at + 1
        feature, limit = re.match(r"If \(feature (\d+) <= ([-\d.Ee]+)\)", line).groups()
        yes, at = node(at + 1)
        no, at = node(at + 1)
        return f"CASE WHEN c.f_{FEATURES[int(feature)]} <= {float(limit)!r}D THEN {yes} ELSE {no} END", at

    return node(0)[0]


class Judge:
    """Boosted trees and thresholds as SQL over a candidate ``c``."""

    def __init__(self, margin: str | None, thresholds: dict[int, float]) -> None:
        self.margin, self.thresholds = margin, thresholds

    @property
    def probability(self) -> str:
        return f"(1D / (1D + exp(-2D * ({self.margin}))))"

    @property
    def accepts(self) -> str:
        if self.margin is None or not self.thresholds:
            return "false"
        least = " ".join(f"WHEN {k} THEN {t!r}D" for k, t in self.thresholds.items())
        return f"{self.probability} >= CASE c.kind {least} ELSE 2D END"


def _pick(options: list[Column], by: Column) -> Column:
    return F.get(F.array(*options), F.pmod(by, F.lit(len(options))).cast("int"))


def _disguised(kind: str, s: Column, by: Column) -> Column:
    """A base span as people hide it; ``by`` is a number that chooses among the ways."""
    digits = _digits(s)
    if kind == "email":
        # Half of the addresses lose their digits, whatever form this corpus has.
        s = F.when(F.shiftright(by, 16) % 2 == 0, s).otherwise(F.translate(s, "0123456789", "abcdefghij"))
        dot = _pick([F.lit(x) for x in (" dot ", "[dot]", " (dot) ", ".", "[.]")], F.shiftright(by, 8))
        at = _pick([F.lit(x) for x in (" at ", "[at]", " (at) ", " [at] ", "{at}", "(at)")], by)
        # A plain sign between plain dots would be a base span again.
        return F.concat(F.replace(F.substring_index(s, "@", 1), F.lit("."), dot), at, F.replace(F.substring_index(s, "@", -1), F.lit("."), dot))
    if kind == "ip":
        groups = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.lower(F.hex(F.pmod(F.xxhash64(s, i), F.lit(65536)))))
        defanged = [F.replace(s, F.lit("."), F.lit(x)) for x in ("[.]", "(.)", "[dot]", " [.] ", "(dot)")]
        return _pick([*defanged, F.array_join(groups, ":")], by)
    if kind == "card":
        cut = [F.substring(digits, at, 4) for at in (1, 5, 9)] + [F.substring(digits, 13, 7)]
        return _pick([F.concat_ws(x, *cut) for x in (".", "_", "/")], by)
    area, first, last = (F.substring(digits, at, n) for at, n in ((-10, 3), (-7, 3), (-4, 4)))
    return _pick(
        [
            F.concat(F.lit("("), area, F.lit(") "), first, F.lit("-"), last), F.concat(F.lit("("), area, F.lit(")"), first, F.lit("-"), last),
            F.concat_ws("-", area, first, last), F.concat_ws(".", area, first, last), F.concat_ws(" ", area, first, last),
        ],
        by,
    )


def _decoy(kind: str, s: Column, words: Column, by: Column) -> tuple[Column, Column]:
    """A string of a base span's shape that is no personal data, and what stands before it; null: what stands before the span."""
    digits = _digits(s)
    if kind == "email":
        a, b, c = (F.get(words, F.pmod(F.shiftright(by, k), F.size(words)).cast("int")) for k in (3, 11, 19))
        return F.lit(None), F.concat(a, _pick([F.lit(" at "), F.lit(" @ ")], by), b, _pick([F.lit("."), F.lit(" dot ")], F.shiftright(by, 5)), c)
    if kind == "ip":
        return F.lit(None), F.array_join(F.transform(F.split(s, r"\."), lambda x: F.concat(F.lit("9"), F.lpad(x, 2, "7"))), "[.]")
    if kind == "card":
        # One digit more, modulo ten, and the check fails.
        last = ((F.substring(digits, 16, 1).try_cast("int") + 1) % 10).cast("string")
        cut = [*[F.substring(digits, at, 4) for at in (1, 5, 9)], F.concat(F.substring(digits, 13, 3), last)]
        return F.lit(None), _pick([F.concat_ws(x, *cut) for x in (".", "_", "/")], by)
    label = _pick([F.lit(x) for x in ("order ", "item #", "isbn ", "ref ", "invoice no. ", "part ", "sku ", "v")], by)
    between = _pick([F.lit("-"), F.lit("."), F.lit(" ")], F.shiftright(by, 7))
    return label, F.concat(F.substring(digits, -10, 3), between, F.substring(digits, -7, 3), between, F.substring(digits, -4, 4))


def _lessons(found: DataFrame) -> DataFrame:
    """``(text, kind, start, end, label)``: snippets with a disguised base span or a decoy of its shape at a known place.

    Every base span gives four of the one and two of the other.
    """
    words = F.filter(F.split(F.substring("text", 1, 2000), r"[^A-Za-z]+"), lambda w: F.char_length(w).between(2, 20))
    every = found.select("mid", words.alias("words"), F.explode_outer("base").alias("b")).where("b IS NOT NULL")
    ways = []
    for way in range(6):
        by = F.shiftrightunsigned(F.xxhash64("mid", "b.start", F.lit(way)), 1)
        made = F.lit(None)
        for k, kind in enumerate(KINDS):
            if way < 4:
                # Half of the disguised spans keep their lead, the others stand after a neutral one.
                front = F.col("b.lead") if way % 2 else F.concat(F.coalesce(F.get("words", F.lit(0)), F.lit("the")), F.lit(" "))
                core = _disguised(kind, F.col("b.match"), by)
            else:
                front, core = _decoy(kind, F.col("b.match"), F.col("words"), by)
                front = F.coalesce(front, F.col("b.lead"))
            made = F.when(F.col("b.kind") == k, F.struct(front.alias("front"), core.alias("core"), F.lit(1.0 if way < 4 else 0.0).alias("label"))).otherwise(made)
        ways.append(made)
    told_apart = every.select(F.col("b.kind").alias("kind"), "b.rest", F.xxhash64("mid", "b.start").alias("key"), F.explode(F.array(*ways)).alias("w"))
    start = F.char_length("w.front")
    return told_apart.where("w.front IS NOT NULL AND w.core IS NOT NULL").select(
        F.concat("w.front", "w.core", "rest").alias("text"), "kind", start.alias("start"), (start + F.char_length("w.core")).alias("end"),
        "w.label", "key",
    )


def _examples(docs: DataFrame, text_col: str) -> DataFrame:
    """Features, label, whether the trees may not see it, and number ``n`` of all candidates to learn from."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Equal texts stay together, so that what is held out was not learned from a copy.
    based = _with_base(rows.withColumn("mid", F.xxhash64("text")), "text", context=True)
    # Outer forms, because the inner ones send a size check, and with it the search, down to the scan a second time.
    natural = _with_proposals(based, "text").select(F.explode_outer("proposed").alias("c"), F.col("mid").alias("key"))
    natural = natural.where("c IS NOT NULL").select("c.*", F.lit(0.0).alias("label"), "key")
    lessons = _lessons(based).withColumn("base", F.array().cast("array<struct<kind:int,start:int,end:int>>"))
    taught = _with_proposals(lessons, "text").select("kind", "start", "end", "label", "key", F.explode_outer("proposed").alias("c"))
    taught = taught.where("c.kind = kind AND c.start < end AND start < c.end").select("c.*", "label", "key")
    held = (F.pmod(F.xxhash64("key"), F.lit(5)) == 0).alias("held")
    every = natural.unionByName(taught)
    return every.groupBy("kind", *[f"f_{f}" for f in FEATURES], "label", held).agg(F.count("*").alias("n"))


def learn(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> Judge:
    """Trees and thresholds from all rows of ``docs``.

    Every base span is disguised four ways, which gives the right proposals; two decoys of each, and all proposals of the
    texts that touch no base span, are the wrong ones. The trees learn on four fifths; on the rest, a kind's threshold is the
    least score from which at least ``precision`` of the proposals are right. A kind that never gets there, or of which
    no text has a base span, adds nothing.
    """
    examples = VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="features").transform(_examples(docs, text_col)).cache()
    try:
        return _fitted(examples, precision)
    finally:
        examples.unpersist()


def _fitted(labelled: DataFrame, precision: float) -> Judge:
    kinds = labelled.where("NOT held").agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        return Judge(None, {})
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="n", maxIter=8, maxDepth=4, seed=7, maxBins=32)
    model = trees.fit(labelled.where("NOT held").select("features", "label", F.col("n").cast("double")))
    margin = " + ".join(f"{w!r}D * ({_case(t.toDebugString)})" for t, w in zip(model.trees, model.treeWeights, strict=True))
    judge = Judge(margin, {})
    scored = labelled.where("held").select("kind", "label", "n", F.struct(*[f"f_{f}" for f in FEATURES]).alias("c"))
    scored = scored.selectExpr("kind", "label", "n", f"round({judge.probability}, 3) AS p").groupBy("kind", "p").agg(
        F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right")
    )
    right: dict[int, list[float]] = {}
    for r in sorted(scored.collect(), key=lambda r: -r["p"]):
        total = right.setdefault(r["kind"], [0.0, 0.0])
        total[0] += r["n"]
        total[1] += r["right"]
        if total[1] >= 3 and total[1] >= precision * total[0] and r["p"] >= 0.5:
            judge.thresholds[r["kind"]] = r["p"] - 5e-4
    return judge


def _with_added(docs: DataFrame, judge: Judge) -> DataFrame:
    """``docs`` with ``added``: accepted proposals that touch no base span and no better accepted proposal."""
    taken = f"array_sort(transform(filter(proposed, c -> {judge.accepts}), c -> struct(c.start AS start, c.end AS end, c.kind AS kind, {judge.probability if judge.margin else '0D'} AS p)))"
    # One order over all proposals, so of any two that touch one is better. In order of their starts, those that a
    # proposal may touch are at most so many places away.
    near = len(KINDS) * (2 * _LONGEST // _SHORTEST)
    better = "struct(d.p, d.end - d.start, -d.start, -d.kind) > struct(c.p, c.end - c.start, -c.start, -c.kind)"
    alone = (
        f"IF(size(taken) < 2, taken, filter(taken, (c, i) -> NOT exists(slice(taken, greatest(i - {near}, 0) + 1, {2 * near + 1}), "
        f"d -> d.start < c.end AND c.start < d.end AND {better})))"
    )
    return (
        docs.withColumn("taken", F.expr(taken)).withColumn("added", F.expr(alone)).drop("taken", "proposed")
    )


def _text_of(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _spans(column: str) -> Column:
    return F.transform(column, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def detect(docs: DataFrame, text_col: str = "text", judge: Judge | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``, arrays of ``(kind, start, end)`` by kind, then start.

    ``kind`` is a place in ``KINDS``; places are code points, ends exclusive. ``spans`` holds the base spans and those
    that the trees add. A null text is empty and has none. Repeated rows, null ids and any other columns pass through;
    columns of these two names are replaced. Without rows nothing is learned and the result is empty.
    """
    judge = judge or learn(docs, text_col)
    kept = docs.drop("base_spans", "spans")
    work = kept.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    work = _with_base(work, "text")
    if judge.accepts != "false":
        work = _with_added(_with_proposals(work, "text"), judge)
        work = work.withColumn("every", F.array_sort(F.concat(_spans("base"), _spans("added"))))
    else:
        work = work.withColumn("every", _spans("base"))
    return work.select(*[F.col("row").getField(c).alias(c) for c in kept.columns], _spans("base").alias("base_spans"), F.col("every").alias("spans"))


def digests(found: DataFrame) -> list[Column]:
    """Counts by kind, the digest of the base spans and the text of all spans, of a ``detect`` result."""
    counts = [F.size(F.filter("base_spans", _of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return [*counts, F.sha2(_text_of(F.col("base_spans")), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans")]


def redact(docs: DataFrame, text_col: str = "text", judge: Judge | None = None) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets, touching spans by the first one's.

    All other columns pass through, whatever their names; null texts stay null.
    """
    judge = judge or learn(docs, text_col)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    found = detect(rows, "text", judge)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def pieces(spans: Column) -> Column:
        reach = _before(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, x: F.greatest(a, x))
        # A span that starts inside an earlier one is part of it: what is between is empty and it has no name.
        each = F.zip_with(
            spans, reach,
            lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(
                F.concat(F.substring(F.col("text"), at + 1, s["start"] - at), F.get(names, s["kind"]))
            ),
        )
        rest = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(each, ""), F.substring(F.col("text"), rest + 1, F.char_length("text")))

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(_let(by_place, pieces))
    return found.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
