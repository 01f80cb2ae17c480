"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them.

Strict patterns give the base spans, which stay. Loose patterns give further candidates. Four labelers look at each
candidate: the strict pattern or checksum, a gazetteer of known values, words beside it, and its shape. The votes
of all candidates, counted by pattern, give each labeler's reliability by expectation-maximisation; the posterior
then is the soft label from which a naive Bayes classifier over a span's features is counted. A candidate that the
classifier accepts becomes a span. Everything on rows is a column expression; the driver sees counts of vote and
feature values, whose number doesn't depend on the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import bound

KINDS = ("email", "ip", "card", "phone")
# Each starts at the end of the match before or where the run of its first class starts: a start within a run
# fails as the run's start does, so none is lost, and a text is read in linear time. Repeats are possessive, as
# nothing that follows them could match in their place.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9A-Fa-f:]))(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?:\G|(?<![0-9]))[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    "phone": r"(?:\G|(?<![0-9+(]))(?:00[1-9][0-9]{0,2}[\x20.-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: What must stand in a text at least for a pattern to be tried.
HINT = {"email": r"@|(?i:[\[(]at[\])])", "ip": "[0-9A-Fa-f][.:][0-9A-Fa-f]", "card": "[0-9]", "phone": "[0-9]"}
#: Known values: mail domains, networks, issuers of cards, dialling codes.
KNOWN = {"email": r"(?:com|org|net|edu|gov|de|fr|es|uk|io)$", "ip": r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|8\.8|2001|fe80)[.:]", "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))", "phone": r"^(?:\+|00)?(?:1|33|34|44|49)[^0-9]"}
#: Words beside a value that speak for its kind.
BESIDE = {"email": r"(?i)\b(?:e-?mail|mail|contact|write|reply|kontakt|correo|courriel)\b", "ip": r"(?i)\b(?:ip|host|server|address|login|from|adresse|dirección)\b", "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|pay|karte|carte|tarjeta)\b", "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|telefon|téléphone|teléfono)\b"}
#: Code points on either side that count as beside.
NEAR = 40
#: Least probability of an added span, and rounds of expectation-maximisation.
ACCEPT, ROUNDS = 0.9, 30
#: Values of the hashed features of the classifier.
SPOTS = 256


def spans(text: Column, pattern: str, hint: str) -> Column:
    """All matches, leftmost and not overlapping: array<struct<start, end, value>>, in code points, end exclusive."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    state = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + F.char_length(p["gap"])
        end = start + F.coalesce(F.char_length(p["hit"]), F.lit(0))
        out = F.when(p["hit"].isNotNull(), F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end"), p["hit"].alias("value"))))).otherwise(s["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.when(text.rlike(hint), F.aggregate(parts, state, step, lambda s: s["out"])).otherwise(none)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: bound(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the strict pattern is a span of its kind."""
    n = F.length(_digits(value))
    return {
        "email": F.lit(True), "ip": value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "card": n.between(14, 19) & luhn(_digits(value)), "phone": n.between(10, 15),
    }[kind]


def base(text: Column) -> dict[str, Column]:
    """The base spans of each kind."""
    holds = lambda kind: lambda s: valid(kind, s["value"])
    return {k: F.filter(spans(text, STRICT[k], HINT[k]), holds(k)) for k in KINDS}


def _candidates(text: Column) -> Column:
    """Every base span, and every loose match that meets none of its kind, with what labelers and features need."""
    def shown(kind: str, found: Column, strict: bool) -> Column:
        left = lambda s: F.substring(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR)))
        right = lambda s: F.substring(text, s["end"] + 1, F.lit(NEAR))
        return F.transform(found, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(strict).alias("strict"), s["value"].alias("value"),
            left(s).alias("left"), right(s).alias("right")))
    got = []
    apart = lambda kind: lambda s: ~F.exists(F.col(kind), lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    for k in KINDS:
        loose = F.filter(spans(text, LOOSE[k], HINT[k]), apart(k))
        got += [shown(k, F.col(k), True), shown(k, loose, False)]
    return F.concat(*got)


def _votes(c: Column) -> list[Column]:
    """The labelers: 1 for, -1 against, 0 neither. Strict pattern, gazetteer, context, shape."""
    def of(rules: dict, yes: Column = F.lit(1), no: Column = F.lit(0), value: Column | None = None) -> Column:
        v = c["value"] if value is None else value
        hit = F.lit(False)
        for k in KINDS:
            hit = F.when(c["kind"] == k, v.rlike(rules[k])).otherwise(hit)
        return F.when(hit, yes).otherwise(no)
    near = F.concat_ws(" ", c["left"], c["right"])
    clean = ~c["left"].rlike(r"[A-Za-z0-9]$") & ~c["right"].rlike(r"^[A-Za-z0-9]")
    checked = F.when(c["strict"], 1).when(c["kind"] == "card", F.when(luhn(_digits(c["value"])), 1).otherwise(-1)).otherwise(0)
    return [checked, of(KNOWN, no=F.lit(-1)), of(BESIDE, value=near), F.when(clean, 1).otherwise(-1)]


def _shape(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")


def _em(counts: dict[tuple, int]) -> dict[tuple, float]:
    """Posterior of each vote pattern under two classes whose labelers err independently."""
    n_labelers = len(next(iter(counts)))
    post = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v in counts}
    for _ in range(ROUNDS):
        total = sum(counts.values()) + 2.0
        mass = sum(counts[v] * p for v, p in post.items()) + 1.0
        prob = [{}, {}]
        for y in (0, 1):
            whole = (mass if y else total - mass) + 3.0
            for j in range(n_labelers):
                for x in (-1, 0, 1):
                    # One count goes each way: a labeler is better than chance before anything is seen.
                    prior = {1: 2.0, 0: 1.0, -1: 0.5}[x if y else -x]
                    prob[y][j, x] = (prior + sum(n * (post[v] if y else 1 - post[v]) for v, n in counts.items() if v[j] == x)) / (whole + 0.5)
        for v in counts:
            odds = math.log(mass / max(1e-9, total - mass)) + sum(math.log(prob[1][j, x] / prob[0][j, x]) for j, x in enumerate(v))
            post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs: doc_id, text, *keep, n_<kind> of base spans, base, spans.

    base and spans are array<struct<start, order, end, kind, added>>, by start, then kind as listed. Null texts are
    empty and have no spans; an empty table gives no rows; other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), *(F.col(c).alias(f"_keep_{c}") for c in keep))
    rows = rows.select("*", *(c.alias(k) for k, c in base(F.col("text")).items()))
    model = fit(rows)
    rows = rows.withColumn("added", accepted(_candidates(F.col("text")), model))
    order = {k: i for i, k in enumerate(KINDS)}
    flat = lambda k: F.transform(F.col(k), lambda s: F.struct(s["start"].alias("start"), F.lit(order[k]).alias("order"), s["end"].alias("end"), F.lit(k).alias("kind"), F.lit(False).alias("added")))
    number = lambda kind: F.element_at(F.create_map(*(F.lit(x) for kv in order.items() for x in kv)), kind)
    more = F.transform(F.col("added"), lambda s: F.struct(s["start"].alias("start"), number(s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(True).alias("added")))
    strict = F.concat(*(flat(k) for k in KINDS))
    return rows.select("doc_id", "text", *(F.col(f"_keep_{c}").alias(c) for c in keep), *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.array_sort(strict).alias("base"), F.array_sort(F.concat(strict, more)).alias("spans"))


def _features(c: Column) -> list[Column]:
    """Hashed features of a candidate: kind with its shape, the word before, the character after."""
    before = F.regexp_extract(c["left"], r"([^ \t-\r]*)[ \t-\r]*$", 1)
    after = F.substring(c["right"], 1, 1)
    spot = lambda *x: F.pmod(F.xxhash64(*x), F.lit(SPOTS)).cast("int")
    return [spot(c["kind"], _shape(c["value"])), spot(c["kind"], F.lower(before)), spot(c["kind"], after)]


def fit(rows: DataFrame) -> dict:
    """Log-odds of each vote pattern and each feature value, from all candidates of rows."""
    c = F.col("c")
    seen = rows.select(F.explode(_candidates(F.col("text"))).alias("c"))
    seen = seen.select(F.array(*_votes(c)).alias("v"), F.explode(F.array(*(F.struct(F.lit(i).alias("i"), f.alias("x")) for i, f in enumerate(_features(c))))).alias("f"))
    table = seen.groupBy("v", "f.i", "f.x").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[tuple, int] = {}
    for v, i, _, n in table:
        if i == 0:
            counts[tuple(v)] = counts.get(tuple(v), 0) + n
    if not counts:
        return {"votes": {}, "features": {}, "prior": 0.0}
    post = _em(counts)
    mass = [2.0, 2.0]
    by: dict[tuple, list[float]] = {}
    for v, i, x, n in table:
        p = post[tuple(v)]
        cell = by.setdefault((i, x), [1.0, 1.0])
        cell[1] += n * p
        cell[0] += n * (1 - p)
        if i == 0:
            mass[1] += n * p
            mass[0] += n * (1 - p)
    odds = {k: math.log(b / (mass[1] + SPOTS)) - math.log(a / (mass[0] + SPOTS)) for k, (a, b) in by.items()}
    votes = {v: math.log(max(p, 1e-9)) - math.log(max(1 - p, 1e-9)) for v, p in post.items()}
    return {"votes": votes, "features": odds, "prior": 0.0}


def accepted(candidates: Column, model: dict) -> Column:
    """The loose candidates that the classifier takes: its features' log-odds on top of the votes' posterior."""
    if not model["votes"]:
        return F.filter(candidates, lambda c: F.lit(False))
    code = lambda v: sum((x + 1) * 3**j for j, x in enumerate(v))
    table = lambda d, n: F.array(*(F.lit(float(d.get(i, 0.0))) for i in range(n)))
    by_vote = table({code(v): w for v, w in model["votes"].items()}, 81)
    by_feature = [table({x: w for (i, x), w in model["features"].items() if i == j}, SPOTS) for j in range(3)]
    least = math.log(ACCEPT / (1 - ACCEPT))

    def takes(c: Column) -> Column:
        vote = sum(((x + 1) * 3**j for j, x in enumerate(_votes(c))), F.lit(0))
        odds = F.get(by_vote, vote)
        for t, f in zip(by_feature, _features(c), strict=True):
            odds = odds + F.get(t, f) / 3
        return ~c["strict"] & (odds >= least)

    return F.filter(candidates, takes)


def masked(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of spans that meet the earlier one counts."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        return F.when(x["start"] >= s["at"], F.struct(x["end"].alias("at"), F.concat(s["out"], F.array(piece, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))).alias("out"))).otherwise(s)

    end = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.lit(2147483647)))
    return F.when(F.size(found) > 0, F.aggregate(found, state, step, end)).otherwise(text)


def listed(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
