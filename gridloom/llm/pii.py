"""Personal data: labelers that vote, reliabilities by expectation-maximisation, a span classifier.

The main path is DataFrame functions only. What reaches the driver are tables of vote patterns
and feature counts, of a few hundred rows at most; the fitted model goes back into the plan as
literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")

# The patterns of each kind. Possessive loops and \G keep them linear on long
# runs; they match what the plain greedy patterns match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[\x20]?[(\[]at[)\]][\x20]?[A-Za-z0-9-]{1,63}(?:(?:\.|[\x20]?[(\[]dot[)\]][\x20]?)[A-Za-z0-9-]{1,63}){1,8}",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
# Gazetteers and context words.
DOMAINS = r"(?i)(?:\.|dot[)\]][\x20]?)(?:com|net|org|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|nl)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write to|correo|courriel|kontakt)",
    "ip": r"(?i)(?:\bip\b|host|server|address|adresse)",
    "card": r"(?i)(?:card|visa|credit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|call|\btel|mobile|fax|telefon|téléphone|teléfono)",
}
COUNTER_CUES = r"(?i)(?:version|token|serial|order|isbn|invoice|\bid\b|hash)"
NEAR = 40


@dataclass(frozen=True)
class SpanModel:
    """log-odds by kind and by (kind, feature, value); empty before any candidate was seen."""

    prior: dict[str, float]
    weight: dict[tuple[str, str, str], float]
    threshold: float


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def passes(kind: str, m: Column) -> Column:
    """The base test of a match of the kind's pattern."""
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))
    if kind == "card":
        size = F.length(_digits(m))
        return F.when((size >= 13) & (size <= 19), F.call_function("luhn_check", _digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _features(kind: str, loose: bool, m: Column, near: Column) -> dict[str, Column]:
    """A candidate's votes (1, 0, or - for none) and shape, as short strings."""
    digits = _digits(m)
    known = {
        "email": m.rlike(DOMAINS),
        "ip": ~m.rlike(r"^(?:0+|127|22[4-9]|2[345][0-9])\."),
        "card": digits.rlike(ISSUERS) & F.length(digits).between(15, 16),
        "phone": F.length(digits).between(10, 13),
    }[kind]
    vote = lambda c: F.when(c, "1").otherwise("0")
    return {
        "regex": F.lit("0") if loose else vote(passes(kind, m)),
        "gazetteer": vote(known),
        "context": F.when(near.rlike(CUES[kind]), "1").when(near.rlike(COUNTER_CUES), "0").otherwise("-"),
        "size": F.least(F.length(digits), F.lit(20)).cast("string"),
        "parted": vote(m.rlike(r"[\x20()\[\]-]")),
        "before": F.when(near.rlike(r"\s$"), "s").when(near.rlike(r"[\p{L}\p{N}]$"), "w").when(near == "", "^").otherwise("o"),
    }


def _matches(text: Column, pattern: str, guard: Column) -> tuple[Column, Column]:
    """The gaps before each match and after the last, and the matches."""
    none = F.array().cast("array<string>")
    return (
        F.when(guard, F.split(text, pattern, -1)).otherwise(none),
        F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
    )


def _sources(text: Column) -> list[tuple[str, bool, str, Column]]:
    """Every candidate source: kind, whether it is a loose pattern, pattern, a cheap guard."""
    has = lambda s: F.contains(text, F.lit(s))
    guards = {"email": has("@"), "ip": has(".") & text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9]{2}|[0-9][ -][0-9]"), "phone": has("+")}
    loose = {"email": has("at)") | has("at]"), "phone": text.rlike("[0-9]{3}[ .-][0-9]{4}")}
    return [(k, False, BASE[k], guards[k]) for k in KINDS] + [(k, True, LOOSE[k], loose[k]) for k in LOOSE]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, found)`` for every row: its matches of all patterns in order, each with
    the length of the gap before it, the last characters of that gap, and its features. Base
    matches that fail their test stay candidates only as cards of 13 to 19 digits. ``row``
    tells repeated documents apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    found = []
    for n, (kind, loose, pattern, guard) in enumerate(_sources(F.col("text"))):
        gaps, hits = _matches(F.col("text"), pattern, guard)

        def one(gap: Column, hit: Column) -> Column:
            near = F.right(gap, F.lit(NEAR))
            fields = [x.alias(name) for name, x in _features(kind, loose, hit, near).items()]
            sound = F.lit(False) if loose else passes(kind, hit)
            return F.struct(
                F.lit(n).alias("source"), F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(hit).alias("size_chars"),
                sound.alias("base"), F.length(_digits(hit)).alias("digits"), F.struct(*fields).alias("f"),
            )

        found.append(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, one))
    return picked.select("row", "doc_id", F.concat(*found).alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """``(row, kind, start, end, base, f)``: candidate spans in code points, end exclusive,
    without loose or failed ones that overlap a base span. Positions are running sums over a
    row's matches, so a text with very many matches costs no more than its length."""
    each = found.select("row", F.posexplode("found").alias("pos", "s")).select("row", "pos", "s.*")
    before = Window.partitionBy("row", "source").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size_chars")).over(before)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size_chars"))
    placed = placed.where(F.col("base") | (F.col("source") >= len(KINDS)) | ((F.col("kind") == "card") & F.col("digits").between(13, 19)))
    in_text = Window.partitionBy("row").orderBy("start", "end")
    prior_end = F.max(F.when(F.col("base"), F.col("end"))).over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    next_start = F.min(F.when(F.col("base"), F.col("start"))).over(in_text.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(prior_end, F.lit(0)) <= F.col("start")) & (F.coalesce(next_start, F.col("end")) >= F.col("end"))
    kept = placed.withColumn("clear", clear).where(F.col("base") | F.col("clear"))
    return kept.select("row", "kind", "start", "end", "base", "f")


def expectation_maximisation(patterns: list[tuple[str, tuple[str, ...], float]], rounds: int = 50) -> dict[tuple[str, tuple[str, ...]], float]:
    """Posterior of "personal" for each (kind, votes) pattern, from the patterns' counts.

    Labelers are independent given the truth, with one hit and one false-alarm rate each; each
    kind has its own prior. ``-`` is no vote."""
    if not patterns:
        return {}
    labelers = range(len(patterns[0][1]))
    hit, alarm = [0.8] * len(labelers), [0.2] * len(labelers)
    prior = {k: 0.5 for k, _, _ in patterns}
    post: dict[tuple[str, tuple[str, ...]], float] = {}
    for _ in range(rounds):
        for kind, votes, _ in patterns:
            yes, no = math.log(prior[kind]), math.log(1 - prior[kind])
            for j, v in enumerate(votes):
                if v != "-":
                    yes += math.log(hit[j] if v == "1" else 1 - hit[j])
                    no += math.log(alarm[j] if v == "1" else 1 - alarm[j])
            post[kind, votes] = 1 / (1 + math.exp(max(-500, min(500, no - yes))))
        for j in labelers:
            cast = [(post[k, v], v[j] == "1", n) for k, v, n in patterns if v[j] != "-"]
            good, bad = sum(p * n for p, _, n in cast), sum((1 - p) * n for p, _, n in cast)
            hit[j] = min(0.999, (sum(p * n for p, y, n in cast if y) + 0.8) / (good + 1))
            alarm[j] = max(0.001, (sum((1 - p) * n for p, y, n in cast if y) + 0.2) / (bad + 1))
        for kind in prior:
            own = [(post[k, v], n) for k, v, n in patterns if k == kind]
            prior[kind] = (sum(p * n for p, n in own) + 0.5) / (sum(n for _, n in own) + 1)
    return post


VOTES = ("regex", "gazetteer", "context")
SHAPE = ("regex", "gazetteer", "context", "size", "parted", "before")


def fit(found: DataFrame, threshold: float = 0.95) -> SpanModel:
    """Fit on every candidate of ``spans``: votes are counted by pattern, reliabilities come
    from the counts, and a naive Bayes classifier over all features learns from the posteriors
    as soft labels."""
    every = found.select("kind", *(F.col(f"f.{x}").alias(x) for x in SHAPE))
    counts = every.groupBy("kind", *SHAPE).count().collect()  # bounded: 4 kinds x 12 votes x 21 sizes x 2 x 4
    patterns: dict[tuple[str, tuple[str, ...]], float] = {}
    for r in counts:
        key = (r["kind"], tuple(r[v] for v in VOTES))
        patterns[key] = patterns.get(key, 0) + r["count"]
    post = expectation_maximisation([(k, v, n) for (k, v), n in sorted(patterns.items())])
    good: dict[tuple[str, str, str], float] = {}
    bad: dict[tuple[str, str, str], float] = {}
    totals: dict[str, list[float]] = {}
    for r in counts:
        p = post[r["kind"], tuple(r[v] for v in VOTES)]
        both = totals.setdefault(r["kind"], [0.0, 0.0])
        both[0] += p * r["count"]
        both[1] += (1 - p) * r["count"]
        for x in SHAPE:
            key = (r["kind"], x, r[x])
            good[key] = good.get(key, 0) + p * r["count"]
            bad[key] = bad.get(key, 0) + (1 - p) * r["count"]
    values = {(k, x): max(2, sum(1 for a, b, _ in good if (a, b) == (k, x))) for k, x in product(totals, SHAPE)}
    prior = {k: math.log((g + 1) / (b + 1)) for k, (g, b) in totals.items()}
    weight = {
        key: math.log((good[key] + 1) / (totals[key[0]][0] + values[key[:2]])) - math.log((bad[key] + 1) / (totals[key[0]][1] + values[key[:2]]))
        for key in good
    }
    return SpanModel(prior, weight, threshold)


def personal(model: SpanModel, kind: Column, feature: dict[str, Column]) -> Column:
    """Whether the classifier takes a candidate for personal data."""
    if not model.prior:
        return F.lit(False)
    score = F.coalesce(F.create_map(*[F.lit(x) for kv in model.prior.items() for x in kv])[kind], F.lit(-99.0))
    for x in SHAPE:
        own = {f"{k}:{v}": w for (k, name, v), w in model.weight.items() if name == x}
        score = score + F.coalesce(F.create_map(*[F.lit(y) for kv in own.items() for y in kv])[F.concat_ws(":", kind, feature[x])], F.lit(0.0))
    return score >= math.log(model.threshold / (1 - model.threshold))


def detect(docs: DataFrame, model: SpanModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, added)`` for every row: arrays of ``(order, kind, start, end)``, sorted
    by kind as listed and then start. ``base`` are the matches of the fixed patterns that pass
    their tests; ``added`` are further candidates that the classifier accepts, fitted on these
    documents where no model is given. A null or empty text has none; repeated rows and null
    ids are rows like others."""
    rows = materialize(candidates(docs, id_col, text_col), "candidates")
    placed = materialize(spans(rows.where(F.size("found") > 0)), "spans")
    if model is None:
        model = fit(placed)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    added = personal(model, F.col("kind"), {x: F.col(f"f.{x}") for x in SHAPE})
    marked = placed.where(F.col("base") | added).select("row", "base", F.struct(order.alias("order"), "kind", "start", "end").alias("span"))
    lists = marked.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("base"), F.col("span")))).alias("added"),
    )
    none = F.array().cast("array<struct<order:int,kind:string,start:bigint,end:bigint>>")
    out = rows.select("row", "doc_id").join(lists.hint("merge"), "row", "left")  # lists grow with the documents: never broadcast
    return out.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with every personal span of the text replaced by its kind in square brackets,
    kind after kind; a null text stays null. Nothing is shuffled."""
    out = docs
    for kind, loose, _, _ in sorted(_sources(F.col(text_col)), key=lambda s: ("email", "phone", "card", "ip").index(s[0])):
        pattern, guard = next((p, g) for k, o, p, g in _sources(F.col(text_col)) if (k, o) == (kind, loose))
        gaps, hits = _matches(F.col(text_col), pattern, guard)

        def one(gap: Column, hit: Column) -> Column:
            features = _features(kind, loose, hit, F.right(gap, F.lit(NEAR)))
            size = F.length(_digits(hit))
            open_case = F.lit(True) if loose else (size.between(13, 19) if kind == "card" else F.lit(False))
            taken = (F.lit(False) if loose else passes(kind, hit)) | (open_case & personal(model, F.lit(kind), features))
            return F.concat(gap, F.when(taken, F.lit(f"[{kind.upper()}]")).otherwise(hit))

        masked = F.concat(F.array_join(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, one), ""), F.element_at(gaps, -1))
        out = out.withColumn(text_col, F.when(F.coalesce(guard, F.lit(False)), F.when(F.size(hits) > 0, masked).otherwise(F.col(text_col))).otherwise(F.col(text_col)))
    return out
