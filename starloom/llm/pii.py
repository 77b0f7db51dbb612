"""Personal data by weak supervision, in Spark expressions only.

Patterns propose spans. Regular-expression, gazetteer and context labelers vote on each one: for, against or nothing.
Expectation-maximisation over the counts of all vote patterns estimates how reliable each labeler is for each kind
without any labelled row, and a logistic span classifier of votes and traits (digits, variety of characters, what follows) is trained on the
posteriors it gives. Both are fitted on grouped counts, whose number is bounded by the kinds, votes and traits and not by the corpus. Spans of the base kinds that pass their checks
always stay; spans of the other kinds stay if the classifier says so.

The gazetteer of given names is learned: a few known ones, and every word that begins a run of capitalised words often enough
right behind a title or the like, anywhere in the corpus.

Places come from the pieces between matches: a match begins after the pieces and matches before it.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialize

# Patterns. Possessive loops and the look-behinds keep the scan linear in the text; on the base kinds they match what the plain form
# matches leftmost: a run is either matched from its first character (or the end of the match before) or not at all.
# Card runs of fewer than 16 digits fail their check anyway and are not proposed.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A few given names, issuers' first digits, calling codes and top-level domains of the gazetteer labelers.
NAMES = (
    "Alice Anna Anton Carlos Carmen Charles Claire Daniel David Elena Emma Francois Hans Isabel James Jean John Jose Juan "
    "Karl Laura Linda Louis Lucia Maria Marie Martin Mary Michael Miguel Patricia Paul Peter Pierre Robert Sofia Thomas William"
).split()
DOMAINS = "com org net edu gov de fr es uk us ca eu io info biz it nl ch at".split()
CODES = "1 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 91".split()
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Senora?|Señora?"
CAPITALISED = rf"(?!(?:{TITLES})(?!\p{{L}}))\p{{Lu}}\p{{Ll}}++"
ADDED = {
    "address": r"(?<![\p{L}0-9])[0-9]{1,5} (?:[A-Z][a-z]++ ){1,3}+(?:Street|Avenue|Road|Lane|Boulevard|Drive)(?![\p{L}0-9])",
    "local_phone": r"(?<![\p{L}0-9+.()-])(?<!\+[0-9]{1,3} )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\p{L}0-9-])",
    "person": rf"(?<![\p{{L}}0-9]){CAPITALISED}(?:[ -]{CAPITALISED})++(?![\p{{L}}0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?:password|passwd|secret|token|api_key)[=:][^\s\"'<>(){}]{6,}+|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])",
    "ssn": r"(?<![\p{L}0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}0-9-])",
}
KINDS = {**BASE, **ADDED}
# Words before a span that speak for its kind, and words that speak against personal data.
CONTEXT = {
    "email": "mail|contact|write|correo|courriel|schreib",
    "ip": r"\bip\b|host|server|address|login|client",
    "card": "card|visa|master|credit|carte|tarjeta|karte|payment",
    "phone": "phone|call|tel|mobile|fax|anruf|appel|llam",
    "address": "address|live|lives|home|deliver|ship|adresse",
    "local_phone": "phone|call|tel|mobile|fax|anruf|appel|llam",
    "person": rf"(?<!\p{{L}})(?:(?:{TITLES.lower()})\.?|(?:name|nom|nombre|contact|signed|patient|customer)(?: is)?[:,]?) $",
    "secret": "key|secret|token|password|credential|access|api",
    "ssn": "ssn|social|security|tax",
}
AGAINST = r"version|isbn|issn|section|chapter|figure|table|invoice|order no|part no|serial"
HASHED = r"commit|revision|checksum|\bsha|digest|\bhash|\bmd5|etag|\bblob|\btree|parent|merge"
AROUND = 40
VOTERS = ("shape", "gazetteer", "context", "edges", "against")
TRAITS = {"digits": 3, "variety": 3, "follows": 3}
ROUNDS, STEPS = 50, 400
PRIOR = 0.5  # weight of what is believed of a labeler, as a share of the spans of a kind
LEAST_ODDS, AGAINST_ODDS = 2.0, 50.0  # of a labeler's vote for its own side, and of the labeler that only votes against
LEAST_CUED, CUED_SHARE = 3, 0.2  # a learned name: so often behind a cue, and in this share of its places


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check; every second digit from the right counts double."""
    doubled = "case when i % 2 = 1 then if(int(x) * 2 > 9, int(x) * 2 - 9, int(x) * 2) else int(x) end"
    name = "__digits"
    return F.expr(f"aggregate(transform(split(reverse({name}), ''), (x, i) -> {doubled}), 0, (a, b) -> a + coalesce(b, 0)) % 10 = 0"), digits.alias(name)


def _proposals(text: Column) -> Column:
    """Per kind, the pieces between matches and the matches: (kind, gap, lead, tail, found), found null in the last piece."""
    def of_kind(number: int, pattern: str) -> Column:
        pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = F.zip_with(
            pieces, found,
            lambda p, m: F.struct(
                F.lit(number).alias("kind"), F.length(p).alias("gap"), F.right(p, F.lit(AROUND)).alias("lead"), F.left(p, F.lit(AROUND)).alias("tail"), m.alias("found")
            ),
        )
        return F.when(text.rlike(pattern), F.transform(rows, lambda x, i: x.withField("place", i))).otherwise(F.array())

    return F.flatten(F.array(*[of_kind(number, pattern) for number, pattern in enumerate(KINDS.values())]))


def proposed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as given, numbered, with the proposed spans; stored, so that numbers stay."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn("proposed_spans", _proposals(text)).withColumn("row_number", F.monotonically_increasing_id())


def placed(found: DataFrame) -> DataFrame:
    """One row per proposed span: row_number, kind, start, end, found, lead and tail."""
    rows = found.select("row_number", F.explode("proposed_spans").alias("s")).select("row_number", "s.*")
    order = Window.partitionBy("row_number", "kind").orderBy("place")
    size = F.coalesce(F.length("found"), F.lit(0))
    after = F.sum(F.col("gap") + size).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    rows = rows.withColumn("end", after).withColumn("tail", F.lead("tail").over(order)).where("found is not null")
    return rows.withColumn("start", F.col("end") - F.length("found"))


def _checked(spans: DataFrame) -> DataFrame:
    """``valid``: the span passes the check of its kind."""
    names = list(KINDS)
    luhn, digits = _luhn(_digits(F.col("found")))
    spans = spans.withColumn("__digits", digits)
    count = F.length("__digits")
    small = F.forall(
        F.split("found", r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
    )
    checks = {"ip": small, "card": count.between(16, 19) & luhn, "phone": count.between(8, 15), "ssn": ~F.col("found").rlike("^(?:000|666|9)|-00-|-0000$")}
    valid = F.lit(True)
    for name, check in checks.items():
        valid = F.when(F.col("kind") == names.index(name), check).otherwise(valid)
    return spans.withColumn("valid", valid)


def _named(spans: DataFrame) -> DataFrame:
    """``given``: whether a person span begins with a given name of the corpus, null for other kinds.

    A run of capitalised words may begin with one that only opens a sentence, so it is cut to where the first given name in it
    stands, two words at least, unless a cue is right before it. Words are counted at all their places, so one that is behind a cue by chance only, as a
    common noun may be, is no name.
    """
    number = list(KINDS).index("person")
    runs = spans.where(F.col("kind") == number)
    words = runs.withColumn("words", F.split("found", "[ -]")).withColumn("cued", F.lower("lead").rlike(CONTEXT["person"]))
    places = words.select("row_number", "start", "words", "cued", F.posexplode(F.slice("words", F.lit(1), F.size("words") - 1)).alias("place", "word"))
    first = F.col("place") == 0
    counts = places.groupBy("word").agg(F.sum((F.col("cued") & first).cast("int")).alias("n"), F.count("*").alias("all"))
    learned = counts.where((F.col("n") >= LEAST_CUED) & (F.col("n") >= CUED_SHARE * F.col("all"))).select("word", F.lit(True).alias("learned"))
    known = places.join(learned, "word", "left").where(F.col("word").isin(NAMES) | F.col("learned") & (F.length("word") > 1))
    known = known.groupBy("row_number", "start").agg(F.min(F.when(F.col("cued"), 0).otherwise(F.col("place"))).alias("place"))
    before = F.aggregate(F.slice("words", F.lit(1), F.coalesce("place", F.lit(0))), F.lit(0), lambda n, w: n + F.length(w) + 1)
    cut = words.join(known, ["row_number", "start"], "left").withColumn("before", before)
    cut = cut.withColumns({"start": F.col("start") + F.col("before"), "found": F.expr("substring(found, before + 1)"), "given": F.col("place").isNotNull()})
    return spans.where(F.col("kind") != number).withColumn("given", F.lit(None).cast("boolean")).unionByName(cut.drop("words", "cued", "place", "before"))


def _votes(spans: DataFrame) -> DataFrame:
    """One column per labeler: 1 for personal data, -1 against, 0 no vote."""
    names = list(KINDS)
    by_kind = lambda tests, other: F.coalesce(*[F.when(F.col("kind") == names.index(k), t) for k, t in tests.items()], other)
    found, lead = F.col("found"), F.lower("lead")
    either = lambda test: F.when(test, 1).otherwise(-1)
    bare = found.rlike("^[0-9a-f]+$")
    value = F.regexp_replace(found, "^[a-z_]+[=:]", "")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    letters = F.regexp_extract(found, r"\.([A-Za-z]+)$", 1)
    cued = lead.rlike(CONTEXT["person"])
    gazetteer = {
        "email": F.when(F.lower(letters).isin(DOMAINS), 1).otherwise(0),
        "ip": F.when(found.rlike(r"^(?:0|127|255)\."), -1).otherwise(0),
        "card": either(found.rlike("^[3-6]")),
        "phone": F.when(found.rlike(r"^\+(?:" + "|".join(CODES) + ")"), 1).otherwise(0),
        "person": F.when(F.col("given"), 1).when(cued, 0).otherwise(-1),
        "secret": F.when(found.rlike("^(?:AKIA|passw)") | ~bare & mixed, 1).otherwise(F.when(bare, 0).otherwise(-1)),
    }
    told = {k: F.when(lead.rlike(words), 1).otherwise(0) for k, words in CONTEXT.items()}
    free = ~F.col("lead").rlike(r"[\p{L}0-9]$") & ~F.coalesce(F.col("tail"), F.lit("")).rlike(r"^[\p{L}0-9]")
    long = F.length("found") > 40
    # A run of capitalised words is no evidence of its own, nor are free edges, which its pattern asks for.
    shape = by_kind({"secret": either(mixed), "person": F.when(long, -1).otherwise(0)}, either(F.col("valid")))
    edges = by_kind({"person": F.lit(0)}, either(free))
    against = F.when(lead.rlike(AGAINST) | (F.col("kind") == names.index("secret")) & bare & lead.rlike(HASHED), -1).otherwise(0)
    votes = (shape, by_kind(gazetteer, F.lit(0)), by_kind(told, F.lit(0)), edges, against)
    return spans.select("*", *[v.cast("int").alias(n) for n, v in zip(VOTERS, votes, strict=True)])


def _traits(spans: DataFrame) -> DataFrame:
    """What a span looks like, in steps of 0 to 2: share of digits, variety of its characters, and what follows it."""
    digits, size = F.length("__digits"), F.length("found")
    kinds = F.size(F.array_distinct(F.split("found", "")))
    next_one = F.substring(F.coalesce("tail", F.lit("")), 1, 1)
    return spans.withColumns(
        {
            "digits": F.when(digits == 0, 0).when(2 * digits < size, 1).otherwise(2),
            "variety": F.when(kinds <= 4, 0).when(kinds <= 9, 1).otherwise(2),
            "follows": F.when(next_one.rlike("^$|[\\s\"']"), 0).when(next_one.rlike("[.,;:!?]"), 1).otherwise(2),
        }
    )


def _belief(side: int, voter: int, vote: int) -> float:
    """Probability of a labeler's vote in a class, as believed beforehand."""
    if VOTERS[voter] == "against":
        return {(1, -1): 0.004, (-1, -1): 0.5}.get((side, vote), 0.005 if vote == 1 else 0.991 if side == 1 else 0.495)
    return 0.4 if vote == side else 0.1 if vote == -side else 0.5


def estimated(counts: list[tuple[int, tuple[int, ...], int]]) -> dict[tuple[int, tuple[int, ...]], float]:
    """Probability of personal data for every (kind, votes), by expectation-maximisation over their counts.

    Two classes per kind; given the class, labelers vote independently. Labelers are believed beforehand to be right four
    times in five, and the one against nearly always; that weighs thirty spans, or the share PRIOR of all where there are many.
    Both classes are taken as equally frequent and a vote speaks for its own side by LEAST_ODDS at least, since the two
    classes of a kind with one or two telling labelers could else be exchanged or merged.
    """
    result: dict[tuple[int, tuple[int, ...]], float] = {}
    for kind in sorted({k for k, _, _ in counts}):
        own = [(v, n) for k, v, n in counts if k == kind]
        total = sum(n for _, n in own)
        weight = max(30.0, PRIOR * total)
        table = {(c, j, v): _belief(c, j, v) for c, j, v in product((1, -1), range(len(VOTERS)), (1, 0, -1))}
        prior = {key: weight * p for key, p in table.items()}
        posterior: list[float] = []
        for _ in range(ROUNDS):
            posterior = []
            for votes, _ in own:
                yes = sum(math.log(table[1, j, v]) for j, v in enumerate(votes))
                no = sum(math.log(table[-1, j, v]) for j, v in enumerate(votes))
                posterior.append(1 / (1 + math.exp(max(-50.0, min(50.0, no - yes)))))
            seen = dict(prior)
            for (votes, n), p in zip(own, posterior, strict=True):
                for j, v in enumerate(votes):
                    seen[1, j, v] += n * p
                    seen[-1, j, v] += n * (1 - p)
            table = {(c, j, v): n / sum(seen[c, j, w] for w in (1, 0, -1)) for (c, j, v), n in seen.items()}
            for j, side in product(range(len(VOTERS)), (1, -1)):
                odds = AGAINST_ODDS if VOTERS[j] == "against" else LEAST_ODDS
                table[-side, j, side] = min(table[-side, j, side], table[side, j, side] / odds)
        result |= {(kind, votes): p for (votes, _), p in zip(own, posterior, strict=True)}
    return result


def _features(kind: int, votes: tuple[int, ...], traits: tuple[int, ...]) -> list[float]:
    steps = [float(t == step) for t, n in zip(traits, TRAITS.values(), strict=True) for step in range(1, n)]
    return [1.0, *(float(kind == k) for k in range(len(KINDS))), *(float(v == side) for v in votes for side in (1, -1)), *steps]


def trained(counts: list[tuple[int, tuple[int, ...], tuple[int, ...], int]], soft: dict[tuple[int, tuple[int, ...]], float]) -> list[float]:
    """Weights of a logistic classifier of kind, votes and traits, fitted to the soft labels by gradient steps on the grouped rows."""
    rows = [(_features(k, v, t), math.log1p(n), soft[k, v]) for k, v, t, n in counts]
    weights = [0.0] * len(_features(0, (0,) * len(VOTERS), (0,) * len(TRAITS)))
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(STEPS):
        slope = [0.001 * w for w in weights]
        for x, n, y in rows:
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(w * f for w, f in zip(weights, x, strict=True))))))
            for i, f in enumerate(x):
                if f:
                    slope[i] += n / total * (p - y) * f
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def classified(found: DataFrame) -> DataFrame:
    """One row per span that stays: row_number, kind (its number in KINDS), start, end, base, score."""
    checked = materialize(_checked(placed(found)).drop("gap", "place"), "checked")
    spans = _traits(_votes(_named(checked))).drop("lead", "tail", "__digits", "found", "given")
    spans = materialize(spans, "spans")
    grouped = spans.groupBy("kind", *VOTERS, *TRAITS).count().collect()  # at most kinds * 3 ** (voters + traits) rows, few of them possible
    counts = sorted((r.kind, tuple(r[v] for v in VOTERS), tuple(r[t] for t in TRAITS), r["count"]) for r in grouped)
    patterns: dict[tuple[int, tuple[int, ...]], int] = {}
    for kind, votes, _, n in counts:
        patterns[kind, votes] = patterns.get((kind, votes), 0) + n
    weights = trained(counts, estimated([(k, v, n) for (k, v), n in patterns.items()]))
    bias, kinds, rest = weights[0], weights[1 : 1 + len(KINDS)], iter(weights[1 + len(KINDS) :])
    linear = F.lit(bias) + F.element_at(F.array(*map(F.lit, kinds)), F.col("kind") + 1)
    for voter in VOTERS:
        linear = linear + F.when(F.col(voter) == 1, next(rest)).when(F.col(voter) == -1, next(rest)).otherwise(0.0)
    for trait, n in TRAITS.items():
        linear = linear + F.element_at(F.array(F.lit(0.0), *[F.lit(next(rest)) for _ in range(1, n)]), F.col(trait) + 1)
    base = (F.col("kind") < len(BASE)) & F.col("valid")
    scored = spans.select("row_number", "kind", "start", "end", base.alias("base"), (1 / (1 + F.exp(-linear))).alias("score"))
    return scored.where("base or (kind >= {} and score >= 0.5)".format(len(BASE)))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id as given and spans, an array of (kind, start, end, base, score) by kind and start.

    Start and end are code points of the whole text, end exclusive. Kinds follow KINDS, whose first four are the base
    kinds; spans of different kinds may overlap. A null or empty text and a text without personal data have an empty array. Rows that
    repeat are searched each; other columns are not looked at.
    """
    found = materialize(proposed(docs.select(id_col, text_col), text_col).drop(text_col), "proposed")
    lists = classified(found).groupBy("row_number").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "base", "score"))).alias("numbered"))
    named = F.transform("numbered", lambda s: s.withField("kind", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)))
    shape = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"
    joined = found.select("row_number", id_col).join(lists, "row_number", "left")
    return joined.select(id_col, F.coalesce(named, F.array().cast(shape)).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span found replaced by its kind, as in <EMAIL>; spans that overlap become one, named by the first.

    Columns and rows stay as they are; texts without a span, null ones too, stay unchanged.
    """
    clash = [c for c in docs.columns if c in ("row_number", "proposed_spans")]
    safe = docs.withColumnsRenamed({c: f"{c}__own" for c in clash})
    found = materialize(proposed(safe, text_col), "proposed")
    order = Window.partitionBy("row_number").orderBy("start", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = classified(found).withColumn("fresh", F.when(F.col("start") < before, 0).otherwise(1))
    spans = spans.withColumn("run", F.sum("fresh").over(order))
    runs = spans.groupBy("row_number", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind"))
    lists = runs.groupBy("row_number").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("runs"))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    touched = found.where(F.size("proposed_spans") > 0).join(lists, "row_number", "left")
    last = F.array(F.struct(F.length(text_col).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), F.lit(-1).alias("kind")))
    steps = F.zip_with(
        F.concat("runs", last), F.concat(F.array(F.lit(0).cast("long")), F.transform("runs", lambda r: r["end"])),
        lambda r, begin: F.concat(
            F.substring(F.col(text_col), (begin + 1).cast("int"), (r["start"] - begin).cast("int")), F.when(r["kind"] >= 0, F.element_at(names, r["kind"] + 1)).otherwise(F.lit(""))
        ),
    )
    touched = touched.withColumn(text_col, F.when(F.col("runs").isNull(), F.col(text_col)).otherwise(F.array_join(steps, "")))
    whole = found.where(F.size("proposed_spans") == 0).select(*safe.columns).union(touched.select(*safe.columns))
    return whole.withColumnsRenamed({f"{c}__own": c for c in clash})
