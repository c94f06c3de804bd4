"""Personal data by weak supervision.

Candidates are the spans of four base rules and of looser nets (numbers without country code, addresses
with a spelt-out "at"). Four labelers vote on each (yes, no, nothing): the base rule, a gazetteer, the
words ahead of the span, and the span's shape. Expectation-maximisation estimates from the votes alone how reliable
each labeler is per kind, and from its posteriors a naive Bayes classifier of span features is trained.
A candidate that no base rule found is added if that classifier is sure and some labeler voted for it.
Base spans always stay.

Everything on the rows is SQL functions: a text is cut at the matches of a rule, so positions are sums of
lengths (in code points). They are summed in strides, and the words ahead of a span are taken from the parts
next to it, so the work on one text is its length plus its matches times ``STRIDE`` (and a square of their
number in strides); the few spans that are added are compared with each base span. To the driver comes one count per combination of kind, votes and features, at
most ``4 * 3**4 * 48`` numbers; the fitted weights go back as a literal map.

Cases: null and empty texts have no spans; equal candidates of two nets count once; repeated rows give
repeated results; further columns are ignored; an empty table, or one without candidates, gives rows
without spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.staging import documents, staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "gazetteer", "context", "shape")
ROUNDS = 25
SURE = 0.95
BEFORE = 40
"""characters ahead of a span that the context labeler reads"""
STRIDE = 128
"""parts of a text whose lengths are summed at a time"""

# Possessive forms of the rules' patterns: the same matches, without backtracking into long runs.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # the whole run of digits with single separators, if it has 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NETS = {
    "email": rf"(?<!{_NAME}){_NAME}++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
# a text without any of these characters has no match
NEEDED = {("email", True): "@", ("phone", True): "+", ("email", False): "(["}

# fixed values: word lists of the labelers
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "example", "test")
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|38"
CUES = {
    "email": "e-?mail|mail|contact|write|reach|courriel|correo",
    "ip": r"\bip\b|address|host|server|login|client|adresse",
    "card": "card|visa|master|amex|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|dial|ring|handy|llam",
}
AGAINST = "version|order|invoice|isbn|issn|section|chapter|part no|serial|article"

_SPAN = "struct<kind: string, start: int, end: int, base: boolean, votes: array<int>, features: array<string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        n = d.cast("int") * (1 + i % 2)
        return F.when(n > 9, n - 9).otherwise(n)

    each = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """The conditions of a base rule beyond its pattern."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        domain = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
        return _vote(domain.isin(*DOMAINS), F.length(domain) > 12)
    if kind == "ip":
        return _vote(match.rlike(r"^(10|127|172|192|[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9])\."), match.rlike(r"^(0|25[0-9])[0-9]*\."))
    if kind == "card":
        return _vote(_digits(match).rlike(f"^({ISSUERS})"), match.startswith("0"))
    return _vote(match.rlike(rf"^\+({CALLING_CODES})"), match.startswith("+0"))


def _context(kind: str, ahead: Column) -> Column:
    return _vote(F.lower(ahead).rlike(CUES[kind]), F.lower(ahead).rlike(AGAINST))


def _shape(kind: str, match: Column) -> Column:
    if kind == "email":
        return _vote(match.rlike(r"\.[A-Za-z]{2,6}$"), ~match.rlike("[A-Za-z]"))
    if kind == "ip":
        return _vote(F.length(match) >= 9, match.rlike(r"(^|\.)0[0-9]"))
    if kind == "card":
        return _vote(F.length(_digits(match)).isin(15, 16), match.rlike("[ -]") & ~match.rlike("^[0-9]{4}[ -]"))
    return _vote(F.length(_digits(match)).between(10, 13), match.rlike(r"[ .-]{2}|\($"))


def _features(match: Column, ahead: Column) -> Column:
    """Three facts about a span, with 4, 4 and 3 values."""
    size = F.length(match)
    return F.array(
        F.when(size < 10, "short").when(size < 16, "middle").when(size < 24, "long").otherwise("longer"),
        F.when(match.rlike(r"[ ()\[\]]"), "spaced").when(match.contains("-"), "dashed").when(match.contains("."), "dotted").otherwise("plain"),
        F.when(F.length(ahead) == 0, "start").when(ahead.rlike(r"[:=(<\"']\x20?$"), "marked").otherwise("text"),
    )


def _summed(sizes: Column, start: Column, count: Column) -> Column:
    return F.aggregate(F.slice(sizes, start + 1, count), F.lit(0), lambda a, n: a + n)


def _cut(text: Column, kind: str, pattern: str, is_rule: bool) -> Column:
    """A text (which holds no \x01) cut at the matches of one pattern: every second part is a match."""
    replaced = F.regexp_replace(text, pattern, "\x01$0\x01")
    needed = NEEDED.get((kind, is_rule))
    if needed:
        replaced = F.when(reduce(or_, (F.contains(text, F.lit(c)) for c in needed)), replaced).otherwise("")
    return F.split(replaced, "\x01", -1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once, however often and wherever the body reads it."""
    return F.transform(F.array(value), body)[0]


def _voted(parts: Column, kind: str, is_rule: bool) -> Column:
    """The candidates of one pattern with their votes and features, from the parts of a text."""

    def place(s: Column, strides: Column, i: Column) -> Column:
        stride = F.floor(i / STRIDE).cast("int")
        start = F.get(strides, stride) + _summed(s["sizes"], stride * STRIDE, i - stride * STRIDE)
        # the shortest match has four characters, so these parts hold BEFORE of them or reach the text's start
        near = F.least(i, F.lit(2 * BEFORE // 4 + 1))
        ahead = F.right(F.array_join(F.slice(s["tails"], i - near + 1, near), ""), F.lit(BEFORE))
        match = F.get(s["parts"], i)
        valid = _valid(kind, match) if is_rule else F.lit(False)
        return F.struct(start.alias("start"), ahead.alias("ahead"), match.alias("match"), valid.alias("base"))

    def span(c: Column) -> Column:
        match, ahead = c["match"], c["ahead"]
        rule = F.when(c["base"], 1).otherwise(-1 if is_rule else 0)
        votes = F.array(rule, _gazetteer(kind, match), _context(kind, ahead), _shape(kind, match))
        return F.struct(
            F.lit(kind).alias("kind"), c["start"].alias("start"), (c["start"] + F.length(match)).alias("end"), c["base"].alias("base"),
            votes.alias("votes"), _features(match, ahead).alias("features"),
        )

    def spans(s: Column) -> Column:
        strides = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(s["sizes"]) / STRIDE).cast("int")), lambda b: _summed(s["sizes"], b * STRIDE, F.lit(STRIDE))
        )
        before = _let(strides, lambda each: F.transform(each, lambda _, b: _summed(each, F.lit(0), b)))
        matches = F.sequence(F.lit(1), F.size(s["parts"]) - 2, F.lit(2))
        return _let(before, lambda sums: F.transform(F.transform(matches, lambda i: place(s, sums, i)), span)).cast(f"array<{_SPAN}>")

    def measured(p: Column) -> Column:
        sizes, tails = F.transform(p, lambda x: F.length(x)), F.transform(p, lambda x: F.right(x, F.lit(BEFORE)))
        return F.struct(p.alias("parts"), sizes.alias("sizes"), tails.alias("tails"))

    none = F.array().cast(f"array<{_SPAN}>")
    return _let(parts, lambda p: F.when(F.size(p) > 1, _let(measured(p), spans)).otherwise(none))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all candidates of every text with their votes and features, without the text."""
    # \x01 separates matches below; it is in no pattern, so another control character does as well
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "\x01", "\x02")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    patterns = [*((k, p, True) for k, p in BASE.items()), *((k, p, False) for k, p in NETS.items())]
    voted = [_voted(_cut(F.col("text"), kind, p, rule), kind, rule) for kind, p, rule in patterns]
    return rows.select("doc_id", F.concat(*voted).alias("spans"))


def estimate(counts: list[tuple[tuple[int, ...], float]], rounds: int = ROUNDS) -> tuple[float, list[list[dict[int, float]]]]:
    """EM on vote patterns with their counts: (prior, per labeler the chance of each vote given no and yes).

    Started from the majority of votes; a labeler is taken to be right more often than not at first.
    """
    labelers = len(counts[0][0])
    total = sum(n for _, n in counts)
    posterior = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v, _ in counts}
    prior, chances = 0.5, []
    for _ in range(rounds):
        prior = (sum(posterior[v] * n for v, n in counts) + 1) / (total + 2)
        chances = []
        for i in range(labelers):
            chances.append([])
            for truth in (0, 1):
                weight = {v: (posterior[v] if truth else 1 - posterior[v]) * n for v, n in counts}
                mass = sum(weight.values())
                own = {x: sum(w for v, w in weight.items() if v[i] == x) for x in (-1, 0, 1)}
                # one imagined observation a vote, two for the vote that fits the truth
                smooth = {-1: 1 + (not truth), 0: 1, 1: 1 + truth}
                chances[i].append({x: (own[x] + smooth[x]) / (mass + 4) for x in own})
        for v, _ in counts:
            posterior[v] = posterior_of(v, prior, chances)
    return prior, chances


def posterior_of(votes: tuple[int, ...], prior: float, chances: list[list[dict[int, float]]]) -> float:
    odds = math.log(prior) - math.log(1 - prior)
    odds += sum(math.log(c[1][v]) - math.log(c[0][v]) for v, c in zip(votes, chances))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def train(rows: list[tuple[str, tuple[int, ...], tuple[str, ...], int]]) -> dict[str, float]:
    """Log odds of the span classifier, by ``kind`` and by ``kind:position:value``.

    Its inputs are the votes and the features; its targets the posteriors that EM gives the votes.
    """
    weights: dict[str, float] = {}
    for kind in KINDS:
        own = [(v, f, n) for k, v, f, n in rows if k == kind]
        if not own:
            continue
        patterns: dict[tuple[int, ...], float] = {}
        for v, _, n in own:
            patterns[v] = patterns.get(v, 0) + n
        prior, chances = estimate(sorted(patterns.items()))
        mass = [0.0, 0.0]
        seen: dict[str, list[float]] = {}
        for v, f, n in own:
            p = posterior_of(v, prior, chances)
            for truth, share in enumerate((1 - p, p)):
                mass[truth] += share * n
                for i, x in enumerate((*v, *f)):
                    seen.setdefault(f"{kind}:{i}:{x}", [0.0, 0.0])[truth] += share * n
        weights[kind] = math.log((mass[1] + 1) / (mass[0] + 1))
        for key, (no, yes) in seen.items():
            weights[key] = math.log((yes + 1) / (mass[1] + 4)) - math.log((no + 1) / (mass[0] + 4))
    return weights


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of ``docs`` (doc_id, text); spans are arrays of (kind, start, end) by kind and start."""
    rows = staged(candidates(docs), "pii-candidates")
    patterns = rows.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.features").count().collect()
    weights = train([(r["kind"], tuple(r["votes"]), tuple(r["features"]), r["count"]) for r in patterns])
    table = F.create_map(*(F.lit(x) for k, w in sorted(weights.items() or {"": 0.0}.items()) for x in (k, w))) if weights else None

    def accepted(s: Column) -> Column:
        if table is None:
            return s["base"]
        inputs = F.concat(s["votes"].cast("array<string>"), s["features"])
        terms = F.transform(inputs, lambda x, i: F.coalesce(table[F.concat_ws(":", s["kind"], i, x)], F.lit(0.0)))
        odds = F.aggregate(terms, table[s["kind"]], lambda a, x: a + x)
        return s["base"] | ((odds > math.log(SURE / (1 - SURE))) & F.exists(s["votes"], lambda v: v == 1))

    rank = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        # equal spans are neighbours once sorted; array_distinct compares structs pair by pair
        once = _let(F.sort_array(keyed), lambda a: F.filter(a, lambda s, i: (i == 0) | (s != F.get(a, i - 1))))
        return F.transform(once, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    base = F.filter("spans", lambda s: s["base"])
    added = F.filter("spans", lambda s: ~s["base"] & accepted(s))
    apart = F.filter(added, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn("base", base).select(
        "doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", apart)).alias("spans")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return find(documents(spark, folder)).selectExpr(
        "doc_id",
        *(f"cast(size(filter(base, s -> s.kind = '{k}')) as long) n_{k}" for k in KINDS),
        f"sha2({joined.format('base')}, 256) base_sha256",
        f"{joined.format('spans')} spans",
    )
