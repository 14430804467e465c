"""Personal data by weak supervision, in DataFrame functions only.

Base patterns give the spans of the contract. Wider patterns add candidates: spelled-out
addresses, phone numbers without a country code, and numbers that fail a base check. Five
labelers vote on every candidate (for, against, abstain): form and validity (regex), gazetteer,
context words, boundaries. Expectation-maximisation over the counts of vote patterns estimates
each labeler's reliability per kind; candidates that pass the base checks are held positive. A
naive Bayes span classifier is then trained on the posteriors, over the votes and features of
the span, and decides which further candidates are personal data. A candidate whose validity
check fails is never added.

Bounds: there are at most 4 x 3**5 vote patterns and a fixed number of features, whatever the
corpus; only these small tables are gathered. The text is read once; candidates are staged.
Null text is empty text. Repeated rows and null ids give one result row each.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.llm.spans import digits, find, joined, luhn, touches
from nextpick.sources.stage import stage

KINDS = ["email", "ip", "card", "phone"]
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Candidates that no base pattern finds.
WIDE = {
    "spelled": rf"(?<!{LOCAL}){LOCAL}++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++",
    "national": r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Gazetteers and context words.
DOMAINS = "com org net edu gov info io co uk de fr es it eu us ca au jp ch nl se".split()
CARD_PREFIXES = "^(4|5[1-5]|2[2-7]|3[47]|30|36|38|35|6011|65|62)"
CONTEXT = {
    "email": r"e-?mail|contact|write to|reach|correo|courriel|mailto",
    "ip": r"\bip\b|host|server|address|client|adresse|direcci",
    "card": r"card|visa|master|credit|payment|karte|carte|tarjeta|amex",
    "phone": r"phone|tel\b|tel[.:]|call|mobile|cell|fax|telefon|t.l.fono|t.l.phone|whatsapp",
}
AGAINST = r"version|order|invoice|isbn|serial|\bref\b|part no|build|release"
CONTEXT_CHARS = 40
VOTES = 5
ROUNDS = 15
ACCEPT = 0.5


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, 2 abstain."""
    return F.when(yes, F.lit(1)).when(no, F.lit(0)).otherwise(F.lit(2))


def _small(part: Column) -> Column:
    return F.length(F.ltrim(part, F.lit("0"))) <= 3


def valid_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: _small(p) & (F.coalesce(
        F.when(_small(p), F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).cast("int")), F.lit(999)) <= 255))


def _checked(kind: str, value: Column) -> Column:
    """The base checks of a kind."""
    number = digits(value)
    if kind == "ip":
        return valid_ip(value)
    if kind == "card":
        return F.length(number).between(12, 19) & luhn(number)
    if kind == "phone":
        return F.length(number).between(9, 15)
    return F.lit(True)


def _known(kind: str, value: Column) -> Column:
    number = digits(value)
    if kind == "email":
        return F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(DOMAINS)
    if kind == "ip":
        return ~F.substring_index(value, ".", 1).isin("0", "127", "255")
    if kind == "card":
        return number.rlike(CARD_PREFIXES)
    return F.when(value.startswith("+"), F.substring(number, 1, 1) != "0").otherwise(~F.substring(number, 1, 1).isin("0", "1"))


def _formed(kind: str, value: Column) -> Column:
    if kind == "email":
        return value.contains("@")
    if kind == "card":
        return value.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){2,3}[0-9]{0,3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$")
    if kind == "phone":
        return value.startswith("+")
    return F.lit(True)


def _judged(kind: str, m: Column, wide: bool) -> Column:
    """A candidate: offsets, whether the base rules take it, its votes and features."""
    v, left, right = m["v"], F.lower(m["left"]), m["right"]
    checked = _checked(kind, v)
    votes = F.concat(*[x.cast("string") for x in (
        _vote(_formed(kind, v), F.lit(True)),
        _vote(checked, F.lit(True)),
        _vote(_known(kind, v), F.lit(True)),
        _vote(left.rlike(CONTEXT[kind]), left.rlike(AGAINST)),
        _vote(~left.rlike(r"[\p{L}\p{N}]$") & ~right.rlike(r"^[\p{L}\p{N}]"), F.lit(True)))])
    return F.struct(m["s"].alias("s"), m["e"].alias("e"), F.lit(KINDS.index(kind)).alias("k"),
                    (F.lit(not wide) & checked).alias("base"), checked.alias("checked"), votes.alias("votes"),
                    F.least(F.length(digits(v)), F.lit(20)).alias("figures"),
                    F.least((F.length(v) / 4).cast("int"), F.lit(12)).alias("size"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidates of its text; one row per row of `docs`."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = find(text, "text", PATTERNS | WIDE, CONTEXT_CHARS).drop("text")
    keep = F.filter(F.col("card"), lambda m: F.length(digits(m["v"])).between(12, 19))
    found = found.withColumn("card", keep)
    kinds = [(k, k, False) for k in KINDS] + [("spelled", "email", True), ("national", "phone", True)]
    return found.select("doc_id", F.concat(*[
        F.transform(name, lambda m: _judged(kind, m, wide)) for name, kind, wide in kinds]).alias("found"))


def _posteriors(patterns: Column) -> Column:
    """EM over an array of (votes, base, n): the probability that each pattern is personal data."""
    cells = F.sequence(F.lit(0), F.lit(3 * VOTES - 1))

    def has(p: Column, c: Column) -> Column:
        return F.substring(p["votes"], (c / 3).cast("int") + 1, F.lit(1)) == (c % 3).cast("int").cast("string")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def fitted(post: Column) -> Column:
        def rates(weight) -> Column:
            whole = total(F.zip_with(patterns, post, lambda p, q: p["n"] * weight(q)))
            return F.transform(cells, lambda c: (total(F.zip_with(
                patterns, post, lambda p, q: F.when(has(p, c), p["n"] * weight(q)).otherwise(0.0))) + 1.0) / (whole + 3.0))

        share = total(F.zip_with(patterns, post, lambda p, q: p["n"] * q)) + 1.0
        return F.struct((share / (total(F.transform(patterns, lambda p: p["n"])) + 2.0)).alias("share"),
                        rates(lambda q: q).alias("yes"), rates(lambda q: 1.0 - q).alias("no"))

    def score(p: Column, m: Column) -> Column:
        odds = F.aggregate(cells, F.log(m["share"] / (1.0 - m["share"])), lambda a, c: a + F.when(
            has(p, c), F.log(F.get(m["yes"], c) / F.get(m["no"], c))).otherwise(0.0))
        return F.when(p["base"], 1.0).otherwise(1.0 / (1.0 + F.exp(-odds)))

    start = F.transform(patterns, lambda p: F.when(p["base"], 1.0).otherwise(
        F.length(F.regexp_replace(p["votes"], "[^1]", "")) / F.lit(2.0 * VOTES)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda post, _: F.get(F.transform(
        F.array(fitted(post)), lambda m: F.transform(patterns, lambda p: score(p, m))), F.lit(0)))


def _features(x: Column) -> Column:
    """Names of the votes and features that the classifier reads."""
    votes = [F.concat(F.lit(f"v{i}="), F.substring(x["votes"], i + 1, 1)) for i in range(VOTES)]
    return F.transform(F.array(*votes, F.concat(F.lit("figures="), x["figures"]), F.concat(F.lit("size="), x["size"])),
                       lambda f: F.concat(x["k"].cast("string"), F.lit("|"), f))


def _pattern(x: Column) -> Column:
    return F.concat(x["k"].cast("string"), F.lit("|"), x["base"].cast("string"), F.lit("|"), x["votes"])


def _as_map(frame: DataFrame, key: str, value: str) -> Column:
    """A small fitted table as one map, read by a scalar subquery."""
    return frame.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m")).scalar()


def train(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posteriors by vote pattern, and the classifier's log ratios by feature."""
    each = found.select(F.explode("found").alias("x"))
    counts = each.groupBy(F.col("x.k").alias("k"), F.col("x.votes").alias("votes"), F.col("x.base").alias("base")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    fitted = (counts.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("votes", "base", "n"))).alias("patterns"))
              .withColumn("post", _posteriors(F.col("patterns")))
              .select("k", F.explode(F.arrays_zip("patterns", "post")).alias("p"))
              .select(_pattern(F.struct("k", "p.patterns.base", "p.patterns.votes")).alias("key"), "p.post"))
    posts = stage(fitted, "pii-posteriors")
    soft = each.withColumn("post", F.coalesce(_as_map(posts, "key", "post")[_pattern(F.col("x"))], F.lit(0.0)))
    grouped = (soft.select(F.explode(F.concat(_features(F.col("x")), F.array(F.concat(F.col("x.k").cast("string"), F.lit("|all"))))).alias("key"), "post")
               .groupBy("key").agg(F.sum("post").alias("yes"), F.sum(1 - F.col("post")).alias("no")))
    whole = grouped.filter(F.col("key").endswith("|all")).select(
        F.substring_index("key", "|", 1).alias("k"), F.col("yes").alias("all_yes"), F.col("no").alias("all_no"))
    ratio = F.log((F.col("yes") + 1) / (F.col("all_yes") + 2)) - F.log((F.col("no") + 1) / (F.col("all_no") + 2))
    weights = (grouped.withColumn("k", F.substring_index("key", "|", 1)).join(F.broadcast(whole), "k")
               .select("key", F.when(F.col("key").endswith("|all"), F.log((F.col("yes") + 1) / (F.col("no") + 1)))
                       .otherwise(ratio).alias("weight")))
    return posts, stage(weights, "pii-classifier")


def _base_of(kind: int) -> Column:
    return F.filter("found", lambda x: x["base"] & (x["k"] == kind))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base (structs s, k, e), added (the same, with a score), for every row of `docs`."""
    found = stage(candidates(docs), "pii-candidates")
    _, weights = train(found)
    model = F.coalesce(_as_map(weights, "key", "weight"), F.create_map().cast("map<string,double>"))
    with_model = found.withColumn("_model", model)

    def score(x: Column) -> Column:
        keys = F.concat(_features(x), F.array(F.concat(x["k"].cast("string"), F.lit("|all"))))
        odds = F.aggregate(keys, F.lit(0.0), lambda a, k: a + F.coalesce(F.col("_model")[k], F.lit(0.0)))
        return 1.0 / (1.0 + F.exp(-odds))

    sure = {f"_base_{k}": _base_of(i) for i, k in enumerate(KINDS)}
    with_base = with_model.withColumns({"base": F.filter("found", lambda x: x["base"])} | sure)
    # Scores only for candidates that could be added; most texts have none.
    loose = F.filter("found", lambda x: ~x["base"] & x["checked"])
    open_ones = F.filter(loose, lambda x: ~reduce(or_, [touches(F.col(b), x["s"], x["e"]) for b in sure]))
    added = F.filter(F.transform(open_ones, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), score(x).alias("score"))),
                     lambda x: x["score"] >= ACCEPT)
    return with_base.select("doc_id", F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))).alias("base"),
                            added.alias("added"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Digest of personal data per document; see `find_personal_data`."""
    from nextpick.llm.common import table

    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.array_sort("base")
    spans = F.array_sort(F.concat("base", F.transform("added", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))))
    counts = [F.size(F.filter("base", lambda x: x["k"] == i)).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"),
                        joined(spans, KINDS).alias("spans"), F.size("added").cast("bigint").alias("n_added"))
