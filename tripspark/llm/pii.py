r"""Personal data: e-mail addresses, IP addresses, card and phone numbers, by rules and by boosted trees over candidates.

The base rules are four patterns (``BASE``), leftmost and not overlapping within a kind, with a check each: parts of an address at most 255,
12 to 19 digits that pass Luhn, 9 to 15 digits; what fails is dropped, nothing is tried again. Base spans always stay.

The rules miss what stands too close to other digits (two cards in a row are one match of 32 digits) or is written differently
(``name (at) host``, ``1[.]2[.]3[.]4``, dots in a card number, a phone number without country code). Generators (``PROPOSED``) propose
spans of all these forms; proposals of different kinds overlap. Each has features of its format (digits, groups, Luhn, parts, brackets)
and of its context (letters and digits next to it, words such as *tel* or *card* before it); the plus sign that the base rule asks for is not one.
A proposal that equals a base span of its kind is labelled 1, one that fails its kind's check or lies on a base span of another kind only
is labelled 0, the others have no label and are decided: by gradient boosted trees, fitted on the labelled ones (a sample of about
``FIT_ROWS`` at most) of three quarters of the documents, with a threshold for each kind calibrated on the rest of the documents: the lowest
score from which on ``PRECISION`` of the labelled proposals are 1, estimated with one more miss; a kind with fewer than ``EVIDENCE`` of
them gets none. Accepted proposals off all base spans are added, the best of each run of overlapping ones.

Everything is DataFrame and SQL functions and Spark ML; a text is read once, and only spans are shuffled. Patterns are written so that a text is
read in time in proportion to its length (possessive, starts at the border of a run).

Defined cases: a null text is empty; a document without spans has the digest of the empty string and an empty list; rows that repeat a doc_id are
documents of their own; no labelled proposals of either label, nothing is added; positions count code points; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.storage import materialize

KINDS = ["email", "ip", "card", "phone"]
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: a local part begins at the border of its run, or where the match before ended
LOCAL_PART = rf"(?:(?<!{LOCAL})|\G){LOCAL}++"
BASE = {
    "email": rf"{LOCAL_PART}@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_DOT = r"(?:\.|\[\.\]| \. )"
PROPOSED = {
    "email": rf"{LOCAL_PART}(?:@| ?[(\[]at[)\]] ?| @ ){LABEL}++(?:(?:\.| ?[(\[]dot[)\]] ?){LABEL}++)*+",
    "ip": rf"(?<![0-9])[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}[ ._/-][0-9]{6}[ ._/-][0-9]{5}|(?:[0-9]{4}[ ._/-]){2,4}[0-9]{1,7})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+|00)?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
#: a text without this character class has no match
NEEDED = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
WORDS = {"email": "(?i)mail|contact|write", "ip": r"(?i)\bip\b|host|server|address", "card": "(?i)card|visa|credit|pay", "phone": "(?i)tel|phone|call|mobile|fax"}
CONTEXT = 24
FIT_ROWS = 200_000
PRECISION = 0.98
EVIDENCE = 20
SCORE_BINS = 1000
FEATURES = ["kind", "length", "digits", "groups", "longest", "shortest", "separators", "luhn", "parts_ok", "brackets", "dots", "joined_before", "joined_after", "context_digits", *[f"word_{k}" for k in KINDS]]


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes Luhn."""
    digit = f"int(substr({digits}, -place, 1))"
    return f"aggregate(sequence(1, length({digits})), 0, (total, place) -> total + if(place % 2 = 1, {digit}, 2 * {digit} - if({digit} > 4, 9, 0))) % 10 = 0"


def parts_ok(value: str) -> str:
    """SQL: whether a value's runs of digits are four numbers of at most 255."""
    return f"regexp_replace({value}, '[^0-9]+', '.') RLIKE '^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])([.]|$)){{4}}$'"


def valid(kind: str, value: str) -> str:
    """SQL: a kind's check."""
    digits = _digits(value)
    return {
        "email": f"{value} RLIKE '[.]|dot'",
        "ip": parts_ok(value),
        "card": f"length({digits}) BETWEEN 12 AND 19 AND {luhn(digits)}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }[kind]


def prefix_sums(numbers: str, run: int = 128) -> str:
    """SQL: the sum of all numbers before each one. In runs, so that no array grows with all of them as it is built."""
    step = "(acc, x) -> named_struct('sum', acc.sum + {0}, 'before', array_append(acc.before, acc.sum))"
    start = "named_struct('sum', 0, 'before', cast(array() AS array<int>))"
    runs = f"transform(sequence(0, (size({numbers}) - 1) div {run}), r -> aggregate(slice({numbers}, r * {run} + 1, {run}), {start}, {step.format('x')}))"
    return f"""aggregate(array({runs}), cast(array() AS array<int>), (none, all) -> flatten(zip_with(all, aggregate(all, {start}, {step.format('x.sum')}).before,
        (r, upto) -> transform(r.before, x -> x + upto))))"""


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _matches(docs: DataFrame, patterns: dict[str, str], prefix: str, context: bool) -> DataFrame:
    """For each kind, the matches and what lies between them: its length, and the characters next to the matches."""
    columns: dict[str, Column] = {}
    for kind, pattern in patterns.items():
        some = f"_text RLIKE {_quoted(NEEDED[kind])}"
        columns[f"{prefix}{kind}"] = F.expr(f"if({some}, regexp_extract_all(_text, {_quoted(pattern)}, 0), cast(array() AS array<string>))")
        around = f", 'tail', right(x, {CONTEXT}), 'head', left(x, {CONTEXT})" if context else ""
        gaps = f"transform(split(_text, {_quoted(pattern)}, -1), x -> named_struct('length', length(x){around}))"
        columns[f"{prefix}gaps_{kind}"] = F.expr(f"if({some}, {gaps}, NULL)")
    return docs.withColumns(columns)


def _spans(docs: DataFrame, kinds: list[str], prefix: str, context: bool) -> DataFrame:
    """Matches and gaps -> spans (start, end, value, and the text before and after)."""
    steps = {f"{prefix}steps_{k}": F.expr(f"zip_with({prefix}{k}, slice({prefix}gaps_{k}, 1, size({prefix}{k})), (v, g) -> length(v) + g.length)") for k in kinds}
    before = {f"{prefix}before_{k}": F.expr(f"if(size({prefix}{k}) > 0, {prefix_sums(f'{prefix}steps_{k}')}, cast(array() AS array<int>))") for k in kinds}
    out: dict[str, Column] = {}
    for k in kinds:
        gap = f"{prefix}gaps_{k}[i]"
        around = f", 'tail', {gap}.tail, 'head', {prefix}gaps_{k}[i + 1].head" if context else ""
        start = f"{prefix}before_{k}[i] + {gap}.length"
        span = f"named_struct('start', {start}, 'end', {start} + length(v), 'value', v{around})"
        out[f"{prefix}spans_{k}"] = F.expr(f"transform({prefix}{k}, (v, i) -> {span})")
    drop = [f"{prefix}{part}{k}" for k in kinds for part in ("", "gaps_", "steps_", "before_")]
    return docs.withColumns(steps).withColumns(before).withColumns(out).drop(*drop)


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``row, doc_id, base`` (kind number, start, end), ``proposed`` (the same, and the value and its context), written without the text."""
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    found = _matches(_matches(read, BASE, "b_", False), PROPOSED, "p_", True).drop("_text")
    found = _spans(_spans(found, KINDS, "b_", False), KINDS, "p_", True)
    base, proposed = [], []
    for i, k in enumerate(KINDS):
        ok = valid(k, "s.value") if k != "email" else "true"
        base.append(f"transform(filter(b_spans_{k}, s -> {ok}), s -> named_struct('start', s.start, 'kind', {i}, 'end', s.end))")
        features = f"""named_struct('start', s.start, 'kind', {i}, 'end', s.end, 'valid', {valid(k, 's.value')}, 'value', s.value, 'tail', s.tail, 'head', s.head)"""
        proposed.append(f"transform(p_spans_{k}, s -> {features})")
    spans = found.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.expr(f"array_sort(concat({', '.join(base)}))").alias("base"),
        F.expr(f"concat({', '.join(proposed)})").alias("proposed"),
    )
    return materialize(spans, "pii-spans")


def proposals(spans: DataFrame) -> DataFrame:
    """One row per proposed span, with its features and label (1, 0 or null) and whether it is ``free`` of base spans."""
    base = spans.select("row", F.explode("base").alias("s")).select("row", "s.*", F.lit(True).alias("rule"))
    made = spans.select("row", F.explode("proposed").alias("s")).select("row", "s.*", F.lit(False).alias("rule"))
    both = base.unionByName(made, allowMissingColumns=True)

    def covered(*keys: str) -> Column:
        """Whether a base span of the same keys overlaps: one that starts no later and ends after the start, or one that starts inside."""
        order = Window.partitionBy(*keys).orderBy("start")
        earlier = F.max(F.when(F.col("rule"), F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, 0))
        later = F.min(F.when(F.col("rule"), F.col("start"))).over(order.rangeBetween(1, Window.unboundedFollowing))
        return F.coalesce((earlier > F.col("start")) | (F.coalesce(later, F.lit(2**31 - 1)) < F.col("end")), F.coalesce(later, F.lit(2**31 - 1)) < F.col("end"))

    equal = F.max(F.col("rule")).over(Window.partitionBy("row", "kind", "start", "end"))
    marked = both.withColumns({"_any": covered("row"), "_own": covered("row", "kind"), "_equal": equal}).filter(~F.col("rule"))
    label = F.when(F.col("_equal"), 1.0).when(~F.col("valid") | (F.col("_any") & ~F.col("_own")), 0.0)
    runs = F.expr("transform(filter(split(value, '[^0-9]+'), x -> x <> ''), x -> length(x))")
    digits = F.expr(_digits("value"))
    shaped = marked.withColumns({"_runs": runs, "_digits": digits})
    flags = {
        "length": F.col("end") - F.col("start"),
        "digits": F.length("_digits"),
        "groups": F.size("_runs"),
        "longest": F.coalesce(F.array_max("_runs"), F.lit(0)),
        "shortest": F.coalesce(F.array_min("_runs"), F.lit(0)),
        "separators": F.length(F.regexp_replace("value", "[A-Za-z0-9]", "")),
        "luhn": F.expr(f"length(_digits) BETWEEN 12 AND 19 AND {luhn('_digits')}"),
        "parts_ok": F.expr(parts_ok("value")),
        "brackets": F.length(F.regexp_replace("value", r"[^()\[\]]", "")),
        "dots": F.length(F.regexp_replace("value", "[^.]", "")),
        "joined_before": F.expr("tail RLIKE '[A-Za-z0-9_]$'"),
        "joined_after": F.expr("head RLIKE '^[A-Za-z0-9_]'"),
        "context_digits": F.length(F.regexp_replace(F.concat("tail", "head"), "[^0-9]", "")),
        **{f"word_{k}": F.expr(f"tail RLIKE {_quoted(w)}") for k, w in WORDS.items()},
    }
    numbers = {name: c.cast("double") for name, c in flags.items()}
    columns = ["row", "kind", "start", "end", (~F.col("_any")).alias("free"), label.alias("label"), *[c.alias(n) for n, c in numbers.items()]]
    return materialize(shaped.select(*columns), "pii-proposals")


def _held_out() -> Column:
    return F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(4)) == 0


def fit_trees(found: DataFrame, fit_rows: int = FIT_ROWS):
    """Boosted trees over the labelled proposals that are not held out, or None without both labels."""
    labelled = found.filter(F.col("label").isNotNull() & ~_held_out())
    seen = labelled.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")).first()  # one row
    if not seen["ones"] or not seen["zeros"]:
        return None
    share = min(1.0, fit_rows / (seen["ones"] + seen["zeros"]))
    drawn = labelled.filter(F.pmod(F.xxhash64(F.lit(9), "row", "start", "kind"), F.lit(1_000_000)) < int(share * 1_000_000))
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=4, stepSize=0.3, seed=11)
    return trees.fit(_assembled(drawn).coalesce(8))


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)


def scored_by(model, found: DataFrame) -> DataFrame:
    scored = model.transform(_assembled(found))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def thresholds(scored: DataFrame, precision: float = PRECISION, evidence: int = EVIDENCE) -> DataFrame:
    """``kind, threshold``: the lowest score from which on the held-out labelled proposals are 1 to at least ``precision``, counted with one more miss."""
    held = scored.filter(_held_out() & F.col("label").isNotNull())
    bins = held.groupBy("kind", F.floor(F.col("score") * SCORE_BINS).alias("bin")).agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("kind").orderBy(F.desc("bin"))  # at most SCORE_BINS + 1 rows a kind
    upto = bins.withColumns({"_ones": F.sum("ones").over(down), "_n": F.sum("n").over(down)})
    good = (F.col("_ones") / (F.col("_n") + 1) >= precision) & (F.col("_ones") >= evidence)
    return upto.filter(good).groupBy("kind").agg((F.min("bin") / SCORE_BINS).alias("threshold"))


def added_spans(found: DataFrame, precision: float = PRECISION) -> DataFrame | None:
    """The proposals without a label, off all base spans, that reach their kind's threshold: the best of each run of overlapping ones."""
    model = fit_trees(found)
    if model is None:
        return None
    scored = materialize(scored_by(model, found).select("row", "kind", "start", "end", "free", "label", "score"), "pii-scored")
    accepted = scored.filter(F.col("label").isNull() & F.col("free")).join(thresholds(scored, precision), "kind").filter(F.col("score") >= F.col("threshold"))
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = accepted.withColumn("_new", F.when(F.col("start") < reached, 0).otherwise(1))
    runs = opened.withColumn("_run", F.sum("_new").over(order))
    best = F.max_by(F.struct("start", "kind", "end"), F.struct("score", F.col("end") - F.col("start"), -F.col("kind"), -F.col("start")))
    return runs.groupBy("row", "_run").agg(best.alias("span")).groupBy("row").agg(F.collect_list("span").alias("added"))


def joined(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, by start, then kind."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.end)), ',')")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """A row per document: base spans counted by kind and digested, and all spans."""
    spans = find_spans(docs)
    added = added_spans(proposals(spans))
    if added is None:
        both = spans.withColumn("_all", F.col("base"))
    else:
        both = spans.join(added, "row", "left").withColumn("_all", F.expr("array_sort(concat(base, coalesce(added, filter(base, s -> false))))"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) AS long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return both.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("_all").alias("spans"))
