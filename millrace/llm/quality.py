"""Quality rules with adaptive thresholds, in DataFrame operations only.

Counts of a text come from built-in functions. Ratios of these counts go into
mergeable quantile sketches per language and source: a histogram over bins that
grow by ``GROWTH``, so a quantile is exact to a hundredth of its value,
whatever the order or number of merges. Sketches of a language, and of
everything, are sums of those below. A group's cutoff lies ``REACH`` times its
spread above its upper quartile; a group of fewer than ``LEAST_DOCS`` documents
takes its language's cutoffs, or the whole corpus's. Cutoffs are joined to the
documents and those beyond one are rejected.

Null text has no words. Null language and source are groups of their own.
Repeated rows count as often as they come. An empty table gives an empty one.
Very long texts are counted whole. Other columns travel under names of their own;
those that have the name of a result are replaced by it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialise

BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
GROWTH = 1.02
LEAST_DOCS = 200
REACH = 6.0
#: Ratios judged, and the least spread that each is taken to have. A document
#: is never rejected for a ratio of at most REACH times that: 0.12 of its words
#: repeated (the base rule fails what is over 0.20), 0.30 of its lines copied.
RATIOS = {
    "symbols": "try_divide(n_symbols, n_words)",
    "copied_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated": "try_divide(n_repeat_words, n_words)",
    "word_length": "try_divide(word_chars, n_words)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
}
SPREADS = {"symbols": 0.02, "copied_lines": 0.05, "repeated": 0.02, "word_length": 0.5, "capitals": 0.05}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words in windows (of ``window`` word hashes) that occur twice or more."""
    n = F.size(hashes)
    at = F.sequence(F.lit(0), n - window)
    keys = F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
    return F.when(n < window, F.lit(None)).otherwise(keys)


def sorted_windows(keys: Column) -> Column:
    return F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))


def repeated_at(pairs: str) -> Column:
    """Positions, in order, of windows that stand beside an equal one in the
    column ``pairs`` of sorted windows. (A column, because an expression would
    be evaluated again for every element.)"""
    near = lambda j: F.get(F.col(pairs), j)["k"]
    beside = F.transform(F.col(pairs), lambda p, j: F.when((near(j - 1) == p["k"]) | (near(j + 1) == p["k"]), p["i"]))
    return F.array_sort(F.filter(beside, lambda i: i.isNotNull()))


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines and n_capitals (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    out = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, BLANKS), ""),
            "_lines": F.filter(F.split(text, "\n"), has_word),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_capitals": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    out = out.withColumn("_keys", repeated_words(F.col("_hashes"))).drop("_hashes")
    unique = F.size(F.array_distinct("_keys")) == F.size("_keys")
    # most texts repeat nothing; only the others are sorted
    plain = F.col("_keys").isNull() | unique
    out = out.withColumn("_pairs", F.when(~plain, sorted_windows(F.col("_keys")))).drop("_keys")
    out = out.withColumn("_at", F.coalesce(repeated_at("_pairs"), F.array().cast("array<int>")))
    last = F.size("_at") - 1
    gaps = F.transform("_at", lambda p, j: F.when(j == last, F.lit(WINDOW)).otherwise(F.least(F.get("_at", j + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)
    return out.withColumn("n_repeat_words", total).drop("_pairs", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bin_of(value: Column) -> Column:
    """-2000 for what is next to nothing."""
    import math

    return F.when(value < 1e-6, F.lit(-2000)).otherwise(F.ceil(F.log(value) / math.log(GROWTH))).cast("int")


def value_of(number: Column) -> Column:
    return F.when(number == -2000, F.lit(0.0)).otherwise(2 * F.pow(F.lit(GROWTH), number) / (GROWTH + 1))


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, ratio, bin, n; with source, then lang too, null and level
    1 and 2 where sketches are merged. Counts leave every task as sums."""
    judged = counted.where(~base_failed())
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), bin_of(F.expr(v)).alias("bin")) for k, v in RATIOS.items()]))
    rows = judged.select("lang", "source", each.alias("_r")).select("lang", "source", "_r.ratio", "_r.bin")
    own = rows.groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n"))
    own = materialise(own.withColumn("level", F.lit(0)), "sketches")
    nothing = F.lit(None).cast("string")
    lang = own.groupBy("lang", "ratio", "bin").agg(F.sum("n").alias("n")).withColumns({"source": nothing, "level": F.lit(1)})
    all_ = own.groupBy("ratio", "bin").agg(F.sum("n").alias("n")).withColumns(
        {"lang": nothing, "source": nothing, "level": F.lit(2)}
    )
    return own.unionByName(lang).unionByName(all_)


def cutoffs(sketch: DataFrame, reach: float = REACH) -> DataFrame:
    """level, lang, source, n_docs and one cutoff per ratio."""
    group = ["level", "lang", "source", "ratio"]
    upto = Window.partitionBy(*group).orderBy("bin")
    rows = sketch.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(Window.partitionBy(*group))})
    quantile = lambda q: F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("bin")))
    rows = rows.groupBy(*group).agg(
        value_of(quantile(0.25)).alias("low"), value_of(quantile(0.75)).alias("high"), F.max("_all").alias("n_docs")
    )
    least = F.create_map(*[F.lit(x) for kv in SPREADS.items() for x in kv])[F.col("ratio")]
    cut = F.col("high") + reach * F.greatest(F.col("high") - F.col("low"), least)
    wide = [F.max(F.when(F.col("ratio") == k, cut)).alias(f"_max_{k}") for k in RATIOS]
    return rows.groupBy("level", "lang", "source").agg(F.max("n_docs").alias("n_docs"), *wide)


def judged(counted: DataFrame, reach: float = REACH, least: int = LEAST_DOCS) -> DataFrame:
    """``counted`` (see ``with_counts``) plus base_failed and kept."""
    cuts = materialise(cutoffs(sketches(counted), reach), "cutoffs")
    names = [f"_max_{k}" for k in RATIOS]
    top = cuts.where("level = 2").select(*[F.col(c).alias(f"_2{c}") for c in names])
    lang = cuts.where((F.col("level") == 1) & (F.col("n_docs") >= least))
    lang = lang.select(F.col("lang").alias("_lang1"), *[F.col(c).alias(f"_1{c}") for c in names])
    own = cuts.where((F.col("level") == 0) & (F.col("n_docs") >= least))
    own = own.select(F.col("lang").alias("_lang0"), F.col("source").alias("_source0"), *[F.col(c).alias(f"_0{c}") for c in names])
    # one row of cutoffs per group that occurs, from the most particular level that is large enough
    groups = cuts.where("level = 0").select("lang", "source")
    groups = (
        groups.join(own, F.col("lang").eqNullSafe(F.col("_lang0")) & F.col("source").eqNullSafe(F.col("_source0")), "left")
        .join(lang, F.col("lang").eqNullSafe(F.col("_lang1")), "left")
        .join(F.broadcast(top), F.lit(True), "left")  # one row
        .select(
            F.col("lang").alias("_lang"),
            F.col("source").alias("_source"),
            *[F.coalesce(f"_0{c}", f"_1{c}", f"_2{c}").alias(c) for c in names],
        )
    )
    groups = materialise(groups, "group_cutoffs")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    beyond = [F.coalesce(F.expr(value) > F.col(f"_max_{k}"), F.lit(False)) for k, value in RATIOS.items()]
    failed = base_failed()
    out = counted.join(groups, same, "left").withColumn("base_failed", failed)
    verdict = ~failed
    for x in beyond:
        verdict = verdict & ~x
    return out.withColumn("kept", verdict).drop("_lang", "_source", *names)


def quality_rules(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``docs`` with their counts, base_failed and kept; text only if asked for.
    Columns lang and source are taken as null where ``docs`` has none."""
    docs = docs.drop(*COUNTS, "n_lines", "n_capitals", "base_failed", "kept")
    others = [c for c in docs.columns if c not in ("text", "lang", "source")]
    carried = [f"_c{k}" for k in range(len(others))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(own) for c, own in zip(others, carried)],
        "text",
        *[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")],
    )
    counted = with_counts(rows)
    counted = counted if keep_text else counted.drop("text")
    out = judged(materialise(counted, "counts", texts=keep_text))
    told = dict(zip(carried, others))
    order = [c for c in docs.columns if keep_text or c != "text"]
    order += [c for c in out.columns if c not in told and c not in order]
    held = {name: own for own, name in told.items()}
    return out.select(*[F.col(held.get(c, c)).alias(c) for c in order])
