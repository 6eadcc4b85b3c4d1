"""Personal data: fixed shapes, and candidates selected by boosted trees."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import written

KINDS = ("email", "ip", "card", "phone", "email_variant", "phone_variant", "card_variant", "number")
EMAIL, IP, CARD, PHONE = range(4)
VARIANTS = (4, 5, 6)
NUMBER = 7

# A match starts where its run of characters starts, or where the last match
# ended (\G); possessive repetition gives the same matches without going back,
# in time that follows the length of the text.
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){11,}+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    # high recall: spelt-out addresses, numbers without +, cards with other separators
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
    r"[a-z0-9-]{1,64}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[a-z0-9-]{2,64}+){1,4}+",
    r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20./-][0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
    r"(?<![0-9A-Za-z])[0-9]{4}([._/\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9A-Za-z])",
    r"(?<!\S)[^\s0-9]*+[0-9]\S*+",
)
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CONTEXT = (
    r"(?i)mail|contact|phone|tel\b|tel\.|call|mobile|fax|card|visa|payment|account|address|\bip\b|host"
)
SECRET = r"(?i)(?:passw|secret|token|key|hash|sha|version)[^\s]*\s*[:=]?\s*[\"']?$"

TASK_ROWS = 100_000
PRECISION = 0.95
BINS = 20
BLOCK = 256


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where it is used in a lambda."""
    return F.transform(F.array(value), use)[0]


def running(lengths: Column) -> Column:
    """Sums of all lengths before each; by blocks, so that long lists stay cheap."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)
    size = F.lit(BLOCK)

    def by_block(blocks: Column) -> Column:
        before = F.transform(
            F.sequence(F.lit(0), F.size(blocks) - 1), lambda b: total(F.slice(blocks, F.lit(1), b))
        )
        return let(
            before,
            lambda done: F.transform(
                F.sequence(F.lit(0), F.size(lengths) - 1),
                lambda i: done[F.floor(i / size).cast("int")]
                + total(
                    F.slice(lengths, (F.floor(i / size) * size + 1).cast("int"), F.pmod(i, size))
                ),
            ),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / size).cast("int")),
        lambda b: total(F.slice(lengths, b * size + 1, size)),
    )
    return let(blocks, by_block)


SPAN = "array<struct<kind:int,start:bigint,end:bigint,found:string,before:string,after:string>>"


def matches(text: Column, kind: int) -> Column:
    """Leftmost non-overlapping matches of a kind, with places and what stands beside them.

    ``split`` gives the pieces between the matches, so places are sums of
    lengths; nothing is searched for twice.
    """
    pattern = F.lit(PATTERNS[kind])
    none = F.array().cast(SPAN)

    def spans(m: Column) -> Column:
        def placed(pieces: Column) -> Column:
            lengths = F.zip_with(
                m,
                F.slice(pieces, 1, F.size(m)),
                lambda x, y: (F.char_length(x) + F.char_length(y)).cast("bigint"),
            )
            return let(
                running(lengths),
                lambda at: F.transform(
                    m,
                    lambda x, i: F.struct(
                        F.lit(kind).alias("kind"),
                        (at[i] + F.char_length(pieces[i])).alias("start"),
                        (at[i] + F.char_length(pieces[i]) + F.char_length(x)).alias("end"),
                        x.alias("found"),
                        F.substring(pieces[i], -40, 40).alias("before"),
                        F.substring(pieces[i + 1], 1, 8).alias("after"),
                    ),
                ),
            )

        return F.when(F.size(m) == 0, none).otherwise(
            let(F.split(text, pattern, -1), placed).cast(SPAN)
        )

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), spans)


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The check sum of a string of at most 19 digits; false for others."""

    def doubled(i: Column) -> Column:
        d = F.substring(number, F.char_length(number) - i, F.lit(1)).cast("int")
        return F.when(F.pmod(i, F.lit(2)) == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.when(
        F.char_length(number).between(1, 19),
        F.pmod(
            F.aggregate(
                F.sequence(F.lit(0), F.char_length(number) - 1),
                F.lit(0),
                lambda total, i: total + doubled(i),
            ),
            F.lit(10),
        )
        == 0,
    ).otherwise(False)


def octets(found: Column) -> Column:
    return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


def hidden(kind: Column, found: Column) -> Column:
    """A base span as its variant is written: without the signs that tell it."""
    bare = F.regexp_replace(found, r"^\+(?:[0-9]{1,3}[\x20.-]?(?=[(0-9][0-9\x20().-]{8,}$))?", "")
    spelt = F.regexp_replace(F.regexp_replace(found, "@", " at "), r"\.", " dot ")
    cut = F.regexp_replace(digits(found), "([0-9]{4})(?=[0-9])", "$1.")
    return F.when(kind == PHONE, bare).when(kind == EMAIL, spelt).otherwise(cut)


def candidates(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Proposed spans, one a row, with their features; a text without any has one null span.

    A valid address, card or phone has a second row, ``twin``, with the
    features that it would have as a variant; it serves for learning alone.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(SPAN)
    proposed = F.when(
        body.rlike("[0-9@]") | body.rlike(r"(?i)[(\[]at[)\]]|\x20at\x20[a-z0-9-]+\x20dot\x20"),
        F.concat(*[matches(body, kind) for kind in range(len(PATTERNS))]),
    ).otherwise(none)
    rows = df.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("drawn"),
    ).select("rid", "id", "drawn", F.explode_outer(proposed).alias("s"))
    whole = F.col("s.found")
    found, number = F.col("found"), F.col("number")
    kind = F.col("s.kind")
    total = digits(whole)
    valid = (
        F.when(kind == EMAIL, True)
        .when(kind == IP, octets(whole))
        .when(kind == CARD, F.char_length(total).between(12, 19) & luhn(total))
        .when(kind == PHONE, F.char_length(total).between(9, 15))
        .otherwise(False)
    )
    twins = F.when(
        F.col("valid") & kind.isin(EMAIL, CARD, PHONE), F.array(F.lit(False), F.lit(True))
    ).otherwise(F.array(F.lit(False)))
    shown = F.when(F.col("twin"), hidden(kind, whole)).otherwise(whole)
    return (
        rows.withColumn("valid", valid)
        .withColumn("twin", F.explode(twins))
        .withColumn("found", shown)
        .select("rid", "id", "drawn", "s", "valid", "twin", "found", digits(found).alias("number"))
        .select(
            "rid",
            "id",
            "twin",
            "valid",
            *[F.col(f"s.{c}").alias(c) for c in ("kind", "start", "end")],
            F.xxhash64("drawn", "s.kind", "s.start").alias("draw"),
            *[value.cast("double").alias(name) for name, value in features(found, number)],
        )
    )


def features(found: Column, number: Column) -> list[tuple[str, Column]]:
    """Format and context of a span."""
    count = lambda pattern: F.regexp_count(found, F.lit(pattern))
    return [
        ("f_length", F.least(F.char_length(found), F.lit(100))),
        ("f_digits", F.least(F.char_length(number), F.lit(40))),
        ("f_letters", count("[A-Za-z]")),
        ("f_groups", count("[0-9]+")),
        ("f_dots", count(r"\.|(?i)\bdot\b")),
        ("f_separators", count(r"[\x20()/_-]")),
        ("f_signs", count("[^A-Za-z0-9\\x20().@+_/-]")),
        ("f_at", found.rlike(r"(?i)@|[(\[\x20]at[)\]\x20]")),
        ("f_plus", F.startswith(found, F.lit("+"))),
        ("f_luhn", (F.char_length(number) >= 12) & luhn(number)),
        ("f_octets", octets(found)),
        ("f_context", F.col("s.before").rlike(CONTEXT)),
        ("f_secret", F.col("s.before").rlike(SECRET)),
        ("f_alone", F.col("s.before").rlike(r"(?:^|\s)$") & F.col("s.after").rlike(r"^(?:\s|[.,;]|$)")),
    ]


FEATURES = [
    "f_" + n
    for n in (
        "length digits letters groups dots separators signs at plus luhn octets context secret alone"
    ).split()
]


def scored(proposed: DataFrame, precision: float) -> DataFrame | None:
    """Candidates that are no base spans and whose score passes; None if nothing can be learned.

    Learns from all candidates. A draw is a hash of the text and the place in
    it, so what is learned follows from the texts, however they are dealt out,
    and of copies of a text one counts. Taken are spans that pass their shape's test, as they are and as variants
    (``twin``), against those that fail it and numbers of no shape. Nothing
    labels the variants themselves, so they are not used for learning, nor is a
    number that overlaps one. Three in four train the trees; on the rest, scores are cut into bins
    and the threshold is the lowest bin from which on the share of true spans
    is at least ``precision``. Candidates with the same features and label are
    one row whose weight is their number, which trees and bins take as that many rows.
    """
    labelled = proposed.where(~F.col("kind").isin(*VARIANTS)).where(
        ~F.col("inside") & ~((F.col("kind") == NUMBER) & F.col("varied"))
    )
    alike = labelled.select("draw", "kind", "start", "twin", "valid", *FEATURES).dropDuplicates(
        ["draw", "kind", "start", "twin"]
    )
    held_out = F.pmod("draw", F.lit(4)) == 0
    weighted = written(
        alike.groupBy(held_out.alias("held_out"), "valid", *FEATURES).agg(
            F.count(F.lit(1)).cast("double").alias("weight")
        ),
        "weighted",
    )
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features")
    weighted = ready.transform(weighted.withColumn("label", F.col("valid").cast("double")))
    train = weighted.where("not held_out")
    seen = {
        r["label"]: r
        for r in train.groupBy("label")
        .agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows"))
        .collect()
    }
    if len(seen) < 2 or min(r["n"] for r in seen.values()) < 10:
        return None
    # a number of tasks that follows from the rows and an order in each: the same rows, the same trees
    tasks = 1 + sum(r["rows"] for r in seen.values()) // TASK_ROWS
    model = GBTClassifier(maxIter=10, maxDepth=3, maxBins=16, seed=1, weightCol="weight").fit(
        train.repartition(tasks, *FEATURES, "label")
        .sortWithinPartitions(*FEATURES, "label")
        .select("features", "label", "weight")
    )

    def with_score(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("score", vector_to_array("probability")[1])

    bins = (
        with_score(weighted.where("held_out"))
        .groupBy(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum(F.col("label") * F.col("weight")).alias("true"), F.sum("weight").alias("n"))
        .orderBy(F.desc("bin"))
        .collect()
    )
    true, total, threshold = 0.0, 0, None
    for b in bins:
        true, total = true + b["true"], total + b["n"]
        if true < precision * total:
            break
        threshold = b["bin"] / BINS
    if threshold is None:
        return None
    open_spans = proposed.where(~F.col("valid") & ~F.col("inside"))  # twins are valid
    return (
        with_score(ready.transform(open_spans))
        .where(F.col("score") >= threshold)
        .select("rid", "kind", "start", "end")
    )


def find_personal_data(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    precision: float = PRECISION,
) -> DataFrame:
    """Personal data in every whole text, by built-in expressions and Spark ML alone.

    Base kinds by shape: ``email``, ``ip`` (parts at most 255), ``card`` (12 to
    19 digits, Luhn), ``phone`` (9 to 15 digits). Generators of high recall
    propose further, overlapping spans: spelt-out addresses, phones without
    ``+``, cards with other separators, any token with a digit. Gradient-boosted
    trees over format and context select those that look like base spans, at a
    threshold calibrated on held-out candidates. Base spans always stay; a
    proposal inside a base span is not repeated.

    Returns one row per input row: the id column, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone``, ``base_sha256`` and ``spans`` (``kind:start:end``
    in code points, end exclusive, by start and then kind); other columns are
    not carried, so none can clash. A null or empty text has none; null ids,
    ties and repeated rows are told apart by row; an empty table gives no rows.
    With too few labelled candidates to learn from, base spans are all.
    """
    proposed = written(candidates(df, id_column, text), "candidates")
    some = proposed.where("kind is not null")
    # overlaps within one text, found by the stretches of 64 characters that spans cover
    stretch = F.explode(
        F.sequence(F.floor(F.col("start") / 64), F.floor((F.col("end") - 1) / 64))
    ).alias("stretch")
    own = some.where("not twin")
    base = own.where(F.col("valid") | F.col("kind").isin(*VARIANTS)).select(
        "rid",
        stretch,
        F.col("start").alias("b_start"),
        F.col("end").alias("b_end"),
        F.col("valid").alias("b_valid"),
    )
    within = (
        own.where(~F.col("valid"))
        .select("rid", "kind", "start", "end", stretch)
        .join(base, ["rid", "stretch"])
        .where((F.col("b_start") < F.col("end")) & (F.col("start") < F.col("b_end")))
        .groupBy("rid", "kind", "start")
        .agg(F.max("b_valid").alias("inside"), F.max(~F.col("b_valid")).alias("varied"))
    )
    marked = written(
        some.join(within, ["rid", "kind", "start"], "left").fillna(False, ["inside", "varied"]),
        "marked",
    )
    chosen = scored(marked, precision)
    span = F.struct(F.col("start"), F.col("kind"), F.col("end"))
    rows = proposed.where("not twin").select(
        "rid",
        "id",
        F.when(F.col("valid") & F.col("kind").isNotNull(), span).alias("base"),
        F.when(F.col("valid") & F.col("kind").isNotNull(), span).alias("any"),
    )
    if chosen is not None:
        extra = chosen.select("rid", span.alias("any"))
        rows = rows.unionByName(extra, allowMissingColumns=True)

    def listed(spans: str) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(
                F.array_sort(spans),
                lambda s: F.concat_ws(
                    ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    per_kind = [
        F.count(F.when(F.col("base.kind") == i, True)).alias(f"n_{KINDS[i]}") for i in range(4)
    ]
    return (
        rows.groupBy("rid")
        .agg(
            F.max("id").alias("id"),
            *per_kind,
            F.collect_list("base").alias("base"),
            F.collect_list("any").alias("any"),
        )
        .select(
            F.col("id").alias(id_column),
            *[f"n_{k}" for k in KINDS[:4]],
            F.sha2(listed("base"), 256).alias("base_sha256"),
            listed("any").alias("spans"),
        )
    )
