"""Secret scans: fixed patterns, and a randomness battery over tokens that no pattern names.

A token is put into the narrowest encoding its characters allow; one that allows none, such as a key behind the
slashes of a path, is cut into its runs of base64, of base64url and of letters and digits, and these are tested. Three tests ask whether it could be a random string
of that encoding: chi-squared for even use of the alphabet, runs above and below the alphabet's middle, and serial
correlation of neighbours. Their smallest p-value, times three, is the token's. Over all tokens of the corpus,
the Benjamini-Hochberg rule rejects randomness within each class of encoding and length, so that of the tokens set
aside as ordinary about one in a hundred at most is random; short tokens, where the tests see little, answer to
their own class. A second cut bounds the estimated share of ordinary tokens among those reported. What is left and
long enough for its encoding is reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muara.llm.common import documents, free_names, write_table
from muara.llm.spans import characters, matches_of, placed

# The contract's patterns. A hex run or an access key below its least length is dropped whole either
# way, so the length stands in the pattern; an assignment is matched first and judged after.
_KEYWORD = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = _KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
#: Listed order of the kinds, which settles ties in the span lists.
KINDS = ("assign", "access", "hex", "random")

#: Tokens for the battery: runs of this many characters or more of the widest alphabet.
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, narrowest first: pattern of the whole token, alphabet in code order, least length for a report.
#: Those beyond the first two need a digit and a letter, or letters of both cases; a run of digits is a number. Words
#: of one case differ little from random letters, so the tests tell them apart from some 64 letters on only.
ENCODINGS = {
    "lower26": ("[a-z]+", _LOWER, 64),
    "upper26": ("[A-Z]+", _UPPER, 64),
    "letters52": ("[A-Za-z]+", _UPPER + _LOWER, 22),
    "hex": ("[0-9a-f]+", _DIGITS + "abcdef", 24),
    "upper_hex": ("[0-9A-F]+", _DIGITS + "ABCDEF", 24),
    "base32": ("[A-Z2-7]+=*", _UPPER + "234567", 24),
    "lower36": ("[0-9a-z]+", _DIGITS + _LOWER, 24),
    "upper36": ("[0-9A-Z]+", _DIGITS + _UPPER, 24),
    "base62": ("[0-9A-Za-z]+", _DIGITS + _UPPER + _LOWER, 22),
    "base64": ("[0-9A-Za-z+/]+=*", _UPPER + _LOWER + _DIGITS + "+/", 22),
    "base64url": ("[0-9A-Za-z_-]+=*", _UPPER + _LOWER + _DIGITS + "-_", 22),
}
ONE_CASE = ("lower26", "upper26")
#: Runs of a token that fits no encoding.
PARTS = {"base64": "[A-Za-z0-9+/]{20,}={0,2}", "base64url": "[A-Za-z0-9_-]{20,}={0,2}", "base62": "[A-Za-z0-9]{20,}"}
#: Expected share of random tokens among those set aside as ordinary.
FALSE_SHARE = 0.01
#: Bound on the estimated share of ordinary tokens among those reported, per class.
REPORTED_SHARE = 0.05
#: p-values are rounded up to this many steps on a log scale down to FLOOR before they are ranked.
STEPS, FLOOR = 400, 1e-12
#: Random tokens have a p-value in the first HIGH steps, above 0.501, in this share; drawn keys of all encodings and 24 to
#: 128 letters: 0.61 to 0.68.
HIGH, HIGH_SHARE = 10, 0.64


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by the logistic form with a cubic term."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * z + F.lit(0.070565663) * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(2.0) * _upper_tail(F.abs(z)))


def _encoding(found: Column) -> tuple[Column, Column]:
    """Name and alphabet of the narrowest encoding; null: none."""
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    mixed = found.rlike("[A-Za-z]") & (found.rlike("[0-9]") | (found.rlike("[a-z]") & found.rlike("[A-Z]")))
    for key, (pattern, letters, _) in reversed(ENCODINGS.items()):
        fits = found.rlike(f"^{pattern}$") & (F.lit(True) if key in ONE_CASE else mixed)
        name, alphabet = F.when(fits, F.lit(key)).otherwise(name), F.when(fits, F.lit(letters)).otherwise(alphabet)
    return name, alphabet


def in_parts(tokens: DataFrame) -> DataFrame:
    """``rid, kind, start, stop, size, found``: tokens that fit an encoding, and the runs of the others."""
    columns = ["rid", "kind", "start", "stop", "size", "found"]
    fits = _encoding(F.col("found"))[0].isNotNull()
    runs = F.concat(*[matches_of(F.col("found"), kind, pattern) for kind, pattern in PARTS.items()])
    cut = placed(tokens.where(~fits).select(F.struct("rid", F.col("start").alias("from")).alias("token"), runs.alias("runs")), "token", "runs")
    start, stop = (F.col("token.from") + F.col(c) for c in ("start", "stop"))
    parts = cut.select(F.col("token.rid").alias("rid"), F.lit("random").alias("kind"), start.alias("start"), stop.alias("stop"), "size", "found")
    return tokens.where(fits).select(*columns).unionByName(parts.distinct())


def joined_spans(spans: DataFrame) -> DataFrame:
    """``rid, start, stop`` of each run of overlapping spans."""
    before = Window.partitionBy("rid").orderBy("start", "stop")
    reach = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("rid", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def randomness(tokens: DataFrame, column: str = "found") -> DataFrame:
    """``tokens`` with ``encoding`` (null: none) and ``p``, the battery's p-value that the token is random."""
    body = F.rtrim(F.col(column), F.lit("="))
    name, alphabet = _encoding(F.col(column))
    rows = tokens.withColumn("encoding", name).withColumn("alphabet_", alphabet).withColumn("body_", body)
    n, k = F.length("body_").cast("double"), F.length("alphabet_").cast("double")
    rows = rows.withColumn("codes_", F.transform(characters(F.col("body_")), lambda c: F.position(c, F.col("alphabet_")) - 1))
    share = n / k
    squares = F.aggregate(
        characters(F.col("alphabet_")),
        F.lit(0.0),
        lambda acc, c: acc + F.pow(n - F.length(F.replace(F.col("body_"), c, F.lit(""))) - share, F.lit(2.0)) / share,
    )
    free = k - 1
    cube = F.pow(squares / free, F.lit(1 / 3))
    chi = _upper_tail((cube - (1 - F.lit(2.0) / (9 * free))) / F.sqrt(F.lit(2.0) / (9 * free)))
    size = F.size("codes_")
    pairs = F.zip_with(F.slice("codes_", F.lit(1), size - 1), F.slice("codes_", F.lit(2), size - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    half = k / 2
    high = F.size(F.filter("codes_", lambda c: c >= half)).cast("double")
    low = n - high
    changes = F.size(F.filter(pairs, lambda x: (x["a"] >= half) != (x["b"] >= half))) + 1
    mean_runs = 2 * high * low / n + 1
    spread = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    runs = F.when(spread > 0, _two_sided(F.try_divide(changes - mean_runs, F.sqrt(spread)))).otherwise(F.lit(0.0))
    mean = F.aggregate("codes_", F.lit(0.0), lambda acc, c: acc + c) / n
    total = F.aggregate("codes_", F.lit(0.0), lambda acc, c: acc + (c - F.col("mean_")) * (c - F.col("mean_")))
    cross = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + (x["a"] - F.col("mean_")) * (x["b"] - F.col("mean_")))
    serial = F.when(F.col("total_") > 0, _two_sided((F.try_divide(F.col("cross_"), F.col("total_")) + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))
    rows = rows.withColumn("mean_", mean).withColumn("total_", total).withColumn("cross_", cross)
    p = F.least(F.lit(1.0), 3 * F.least(chi, runs, serial))
    return rows.withColumn("p", p).drop("alphabet_", "body_", "codes_", "mean_", "total_", "cross_")


def reported_tokens(tested: DataFrame) -> DataFrame:
    """The tokens that are reported as random within their encoding and length class.

    Two cuts hold. The Benjamini-Hochberg rule sets a token aside as ordinary so that at most ``FALSE_SHARE`` of those
    set aside are random. Of what it leaves, the least likely random ones go until the estimated share of ordinary
    tokens among the reported is at most ``REPORTED_SHARE``: a class holds about as many random tokens as those in
    the first ``HIGH`` steps stand for, one more and a standard deviation allowed, and what is reported beyond them is taken for
    ordinary. p-values are rounded up to steps, so a class has STEPS counts at most and no class is ranked row by row.
    The thresholds are one row per class.
    """
    group = F.concat_ws(":", "encoding", F.floor(F.log2(F.col("size").cast("double"))).cast("string"))
    width = -F.log10(F.lit(FLOOR)) / STEPS
    step = F.floor(-F.log10(F.greatest(F.col("p"), F.lit(FLOOR))) / width).cast("int")
    rows = tested.where("encoding is not null").withColumn("class_", group).withColumn("step_", step)
    counts = rows.groupBy("class_", "step_").agg(F.count(F.lit(1)).alias("n"))
    upward = Window.partitionBy("class_").orderBy(F.col("step_").desc())
    downward = Window.partitionBy("class_").orderBy("step_")
    whole = Window.partitionBy("class_")
    ranked = counts.select(
        "class_",
        "step_",
        F.sum("n").over(upward).alias("rank"),
        F.sum("n").over(downward).alias("reported"),
        F.sum("n").over(whole).alias("total"),
        F.sum(F.when(F.col("step_") < HIGH, F.col("n")).otherwise(0)).over(whole).alias("high"),
    )
    edge = lambda k: F.pow(F.lit(10.0), -(F.col("step_") + k) * width)
    aside = edge(0) <= F.col("rank") / F.col("total") * FALSE_SHARE
    drawn = (F.col("high") + 1 + F.sqrt("high")) / HIGH_SHARE
    bounded = F.col("reported") - drawn * (1 - edge(1)) <= REPORTED_SHARE * F.col("reported")
    cuts = ranked.groupBy("class_").agg(F.min(F.when(aside, F.col("step_"))).alias("cut_"), F.max(F.when(bounded, F.col("step_"))).alias("last_"))
    kept = rows.join(cuts, "class_").where("(cut_ is null or step_ < cut_) and step_ <= last_")
    return kept.drop("class_", "step_", "cut_", "last_")


def scanned(docs: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
    """One row per document and none of its text: ``rid, doc_id, matches`` and ``also``, written to the shared folder."""
    text = F.coalesce("text", F.lit(""))
    guard = _KEYWORD + "[\"']?\\x20*[:=]"
    found = F.concat(
        matches_of(text, "assign", ASSIGN, guard), matches_of(text, "access", ACCESS), matches_of(text, "hex", HEX), matches_of(text, "random", TOKEN)
    )
    return write_table(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), found.alias("matches"), *also), "secrets")


def secret_spans(docs_scanned: DataFrame) -> DataFrame:
    """``rid, kind, start, stop`` of all spans; a random token inside a pattern's span is that span's.

    Random parts of a token that overlap are one span.
    """
    each = write_table(placed(docs_scanned.select("rid", "matches"), "rid", "matches"), "secret-spans")
    value = F.regexp_extract("found", ASSIGN, 2)
    fixed = each.where((F.col("kind").isin("access", "hex")) | ((F.col("kind") == "assign") & (F.length(value) >= 6)))
    least = F.lit(None).cast("int")
    for key, (_, _, size) in ENCODINGS.items():
        least = F.when(F.col("encoding") == key, F.lit(size)).otherwise(least)
    tested = randomness(in_parts(each.where("kind = 'random'"))).select("rid", "start", "stop", "size", "encoding", "p")
    drawn = reported_tokens(write_table(tested, "secret-tokens")).where(F.col("size") >= least)
    f, r = fixed.alias("f"), drawn.alias("r")
    inside = (F.col("f.rid") == F.col("r.rid")) & (F.col("f.start") < F.col("r.stop")) & (F.col("r.start") < F.col("f.stop"))
    columns = ["rid", "kind", "start", "stop"]
    own = joined_spans(r.join(f, inside, "left_anti").select("rid", "start", "stop")).withColumn("kind", F.lit("random"))
    return fixed.select(*columns).unionByName(own.select(*columns))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random`` for every row of ``docs``.

    Null text counts as empty: no spans, and the hash of the empty string. Repeated rows and equal or null ids each
    keep their row. Extra columns are ignored.
    """
    rows = scanned(docs)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = secret_spans(rows).groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "stop"))).alias("all")
    )
    show = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    found = F.coalesce("all", F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>"))
    number = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = rows.select("rid", "doc_id").join(spans, "rid", "left").withColumn("all", found)
    base = F.array_join(F.transform(F.filter("all", lambda s: s["kind"] != "random"), show), ",")
    return listed.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("all", show), ",").alias("spans"),
        number("random"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each run of overlapping spans in ``text`` replaced by ``mark``; ``n_chars``, if there, follows.

    Null text stays null. Spans follow from the text alone, so texts are met by their hashes and equal rows are
    rewritten alike.
    """
    first, second, held = free_names(docs, "key", "check", "runs")
    keys = [F.xxhash64("text").alias(first), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(-1)).alias(second)]
    rows = scanned(docs, keys)
    runs = joined_spans(secret_spans(rows))
    listed = runs.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(held))
    known = listed.join(rows.select("rid", first, second), "rid").drop("rid").dropDuplicates([first, second])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text, found = F.col("text"), F.col(held)

    def piece(i: Column) -> Column:
        begin = F.coalesce(F.get(found, i - 1)["stop"], F.lit(0))
        stop = F.coalesce(F.get(found, i)["start"], F.length(text).cast("long"))
        return F.substring(text, (begin + 1).cast("int"), (stop - begin).cast("int"))

    clean = F.array_join(F.transform(F.sequence(F.lit(0), F.size(found)), piece), mark)
    all_rows = docs.select(*columns, *keys).join(known, [first, second], "left")
    kinds = dict(docs.dtypes)
    new = all_rows.withColumn("text", F.when(found.isNull(), text).otherwise(clean))
    if "n_chars" in docs.columns:
        length = F.when(found.isNull(), F.col("n_chars")).otherwise(F.length("text"))
        new = new.withColumn("n_chars", length.cast(kinds["n_chars"]))
    return new.select(*columns)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))
