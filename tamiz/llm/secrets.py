"""Secret scans: fixed patterns, and a battery of randomness tests on tokens of unknown form.

A token's encoding is inferred from its characters. Under the hypothesis that it is uniformly random
in that alphabet, a chi-squared test of the characters, a runs test of the character classes and
a serial-correlation test must all be passed. How text does in the same three tests is measured on the collection, in each
encoding and band of lengths: on the tokens that fail the battery, by their median and their spread. A token's three statistics are standardised so and added; what text's sums are like is measured in the same way, and
gives the p-value of the token being text. Tokens for which that is too unlikely are reported, the false
discoveries among them held at a fixed rate within each encoding and band of lengths (Benjamini and Hochberg).
"""

from __future__ import annotations

import math

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from tamiz.llm.common import stored

#: The base patterns, tried from the left without overlaps, and the length a match or its value must have.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
#: In the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")
#: Shortest token that is tested, padding included. A run ends at a = that is no padding.
SHORTEST = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{14,}+(?:=++(?![A-Za-z0-9+/_-]))?"
#: What a run is split into if it fits no alphabet: parts of names and paths, and parts between names.
WHOLE = r"^(?:[A-Za-z0-9_-]+|[A-Za-z0-9+/]+)=*$"
PARTS = (r"[A-Za-z0-9_-]{14,}+=*+", r"[A-Za-z0-9+/]{14,}+=*+", r"[A-Za-z0-9+]{14,}+=*+")
#: Alphabets from the narrowest on: name, characters that may occur, alphabet. Padding is not counted.
ALPHABETS = (
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", r"^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", r"^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64url", r"^[0-9A-Za-z_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("base64", r"^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
CLASSES = ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Limit of each randomness test in standard deviations, and false discoveries allowed.
LIMIT = 3.9
RATE = 0.001
#: What text is taken for where too few tokens fail the battery: coincidences among all pairs of characters, changes of
#: class among all neighbours, and how many tokens are too few.
TEXT_SQUARES = 0.075
TEXT_CHANGES = 0.2
FEW = 50
#: Steps of a p-value's negative log10 in the histogram, and where it ends.
STEP, TOP = 0.25, 40


def spans(text: Column, pattern: str, kind: str, group: int = 0, shortest: int = 1) -> Column:
    """Array of (start, end, kind, value) of the matches whose ``group`` has ``shortest`` characters.

    What lies between matches and the matches themselves follow each other, so lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>").alias("all"))

    def place(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        keep = F.length(x["value"]) >= shortest
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["all"], F.array(span))).otherwise(state["all"]).alias("all"))

    zipped = F.zip_with(F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match")), value,
                        lambda x, v: F.struct(x["gap"].alias("gap"), x["match"].alias("match"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    # Most texts hold no match; they are not cut.
    return F.when(text.rlike(pattern), F.aggregate(zipped, start, place)["all"]).otherwise(none)


def _rank(x: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])


def _ordered(all_spans: Column) -> Column:
    keyed = F.transform(all_spans, lambda x: F.struct(x["start"].alias("s"), _rank(x).alias("r"), x["end"].alias("e"), x["kind"].alias("k")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["k"], x["s"], x["e"])), ",")


def battery(token: Column) -> Column:
    """Struct (encoding, n, z_chi, z_runs, z_serial, pairs, changes, order) of a token; encoding is NULL if none fits.

    The z values belong to the hypothesis of randomness. The last three are what the tests measure, each the greater the
    more random: less the share of coincidences among all pairs, the share of neighbours of two classes, and less the distance of the serial
    correlation from that of random tokens.
    """
    bare = F.regexp_replace(token, "=+$", "")
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, pattern, letters in reversed(ALPHABETS):
        fits = bare.rlike(pattern)
        name, alphabet = F.when(fits, label).otherwise(name), F.when(fits, letters).otherwise(alphabet)
    # An array of one, so that the token is taken apart once and then referred to.
    seen = F.array(F.struct(bare.alias("t"), name.alias("name"), alphabet.alias("letters")))
    measured = F.transform(F.transform(seen, _measures), _verdict)
    return F.get(measured, F.lit(0))


def _measures(x: Column) -> Column:
    """Counts of a token from which all tests are made."""
    t, letters = x["t"], x["letters"]
    n = F.length(t).cast("double")
    squares = F.aggregate(F.split(letters, ""), F.lit(0.0), lambda a, c: a + F.pow(
        (F.length(t) - F.length(F.replace(t, c, F.lit("")))).cast("double"), F.lit(2.0)))
    codes = F.transform(F.split(t, ""), lambda c: F.position(c, letters).cast("double"))
    shares = [(F.length(letters) - F.length(F.translate(letters, c, ""))) / F.length(letters) for c in CLASSES]
    squared = [s * s for s in [*shares, F.lit(1.0) - shares[0] - shares[1] - shares[2]]]
    return F.struct(
        x["name"].alias("name"), n.alias("n"), F.length(letters).cast("double").alias("k"), squares.alias("squares"),
        (F.regexp_count(t, F.lit("[0-9]+|[A-Z]+|[a-z]+|[^0-9A-Za-z]+")) - 1).cast("double").alias("changes"),
        (F.lit(1.0) - squared[0] - squared[1] - squared[2] - squared[3]).alias("change"),
        F.aggregate(codes, F.lit(0.0), lambda a, v: a + v).alias("sum"),
        F.aggregate(codes, F.lit(0.0), lambda a, v: a + v * v).alias("sum2"),
        F.aggregate(F.zip_with(codes, F.concat(F.slice(codes, 2, F.size(codes)), F.slice(codes, 1, 1)), lambda a, b: a * b),
                    F.lit(0.0), lambda a, v: a + v).alias("lagged"))


def _verdict(m: Column) -> Column:
    n, k = m["n"], m["k"]
    z_chi = (m["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    mean = (n - 1) * m["change"]
    z_runs = (m["changes"] - mean) / F.sqrt(F.greatest((n - 1) * m["change"] * (1 - m["change"]), F.lit(0.25)))
    spread = n * m["sum2"] - m["sum"] * m["sum"]
    serial = F.when(spread > 0, (n * m["lagged"] - m["sum"] * m["sum"]) / spread).otherwise(1.0)
    z_serial = (serial + 1 / (n - 1)) * F.sqrt(n)
    return F.struct(m["name"].alias("encoding"), n.alias("n"), z_chi.alias("z_chi"), z_runs.alias("z_runs"), z_serial.alias("z_serial"),
                    (-(m["squares"] - n) / (n * (n - 1))).alias("pairs"), (m["changes"] / (n - 1)).alias("changes"),
                    (-F.abs(serial + 1 / (n - 1))).alias("order"))


def _passes(b: Column) -> Column:
    return (b["encoding"].isNotNull() & (F.abs(b["z_chi"]) <= LIMIT) & (F.abs(b["z_runs"]) <= LIMIT)
            & (F.abs(b["z_serial"]) <= LIMIT))


def _band(n: Column) -> Column:
    """Lengths by powers of the square root of two."""
    return F.floor(2 * F.log2(n.cast("double"))).cast("int")


def _step(log_p: Column) -> Column:
    return F.least(F.floor(-log_p / F.log(F.lit(10.0)) / STEP), F.lit(int(TOP / STEP))).cast("int")


def _tail(z: Column) -> Column:
    """Natural logarithm of a bound on the chance of a normal value above ``z``; 0 up to one standard deviation."""
    return F.when(z > 1, -z * z / 2 - F.log(z * math.sqrt(2 * math.pi))).otherwise(F.lit(0.0))


def _middle_and_spread(x: str) -> list[Column]:
    """Median, and how far a standard deviation reaches to the wider side of it."""
    low, middle, high = (F.percentile_approx(x, q, 10_000) for q in (0.1587, 0.5, 0.8413))
    return [middle.alias(f"{x}_at"), F.greatest(middle - low, high - middle, F.lit(1e-3)).alias(f"{x}_by")]


def _strata(tokens: DataFrame, measures: list[str]) -> dict[str, list[float]]:
    """Median and spread of each measure over the tokens, by "encoding:band" and, over all bands, "encoding".

    Strata of fewer than FEW tokens are left out. There are a few encodings and the powers of the length: some hundred rows.
    """
    rows = tokens.groupingSets([[F.col("encoding"), F.col("band")], [F.col("encoding")]], "encoding", "band").agg(
        F.grouping("band").alias("every"), F.count("*").alias("tokens"), *[c for m in measures for c in _middle_and_spread(m)]).filter(
        F.col("tokens") >= FEW).collect()
    return {r["encoding"] if r["every"] else f"{r['encoding']}:{r['band']}": [r[f"{m}_{k}"] for m in measures for k in ("at", "by")] for r in rows}


def _found_in(table: dict[str, list[float]], encoding: Column, band: Column) -> Column:
    """The numbers of a token's stratum, or of its encoding, or NULL."""
    if not table:
        return F.lit(None).cast("array<double>")
    known = F.create_map(*[v for k, row in table.items() for v in (F.lit(k), F.array(*[F.lit(float(x)) for x in row]))])
    return F.coalesce(F.try_element_at(known, F.concat_ws(":", encoding, band)), F.try_element_at(known, encoding))


def text_chances(tested: DataFrame) -> DataFrame:
    """``tested`` (encoding, band, b: a :func:`battery`, passes, ...) with ``log_p``, the natural logarithm of the chance that text is so random.

    A token's chance is the greater of two: what the collection tells, if it can, and what TEXT_SQUARES and TEXT_CHANGES do,
    to which serial correlation tells nothing. The tokens that fail the battery are the less random part of text, and the second
    holds where they are few or much alike.
    """
    names = ["pairs", "changes", "order"]
    measured = tested.withColumns({m: F.col(f"b.{m}") for m in names} | {"n": F.col("b.n")})
    own = _found_in(_strata(measured.filter("not passes"), names), F.col("encoding"), F.col("band"))
    summed = sum((F.col(m) - F.get("own", F.lit(2 * i))) / F.get("own", F.lit(2 * i + 1)) for i, m in enumerate(names))
    added = measured.withColumn("own", own).withColumn("summed", summed)
    sums = _found_in(_strata(added.filter("not passes and own is not null"), ["summed"]), F.col("encoding"), F.col("band"))
    n = F.col("n")
    all_pairs = n * (n - 1) / 2
    given = ((F.col("pairs") + TEXT_SQUARES) * F.sqrt(all_pairs / TEXT_SQUARES)
             + (F.col("changes") - TEXT_CHANGES) * F.sqrt((n - 1) / (TEXT_CHANGES * (1 - TEXT_CHANGES)))) / math.sqrt(2)
    z = F.least(given, (F.col("summed") - F.get("sums", F.lit(0))) / F.get("sums", F.lit(1)))
    return added.withColumn("sums", sums).withColumn("log_p", _tail(z)).drop(*names, "n", "own", "summed", "sums")


def candidates(text: Column) -> Column:
    """Array of (start, end, kind, value) of the tokens to test.

    A run that fits no alphabet, such as a path with names in it, is split at / and +, at _ and -, and at
    all of them but +; each part long enough is a token, so that parts may overlap.
    """
    def parts(x: Column) -> Column:
        split = F.flatten(F.array(*[spans(x["value"], p, "random", 0, SHORTEST) for p in PARTS]))
        moved = F.transform(split, lambda y: F.struct(
            (y["start"] + x["start"]).alias("start"), (y["end"] + x["start"]).alias("end"), y["kind"].alias("kind"),
            y["value"].alias("value")))
        return F.when(x["value"].rlike(WHOLE), F.array(x)).otherwise(F.array_distinct(moved))

    return F.flatten(F.transform(spans(text, CANDIDATE, "random", 0, SHORTEST), parts))


def thresholds(tokens: DataFrame) -> DataFrame:
    """encoding, band, least: the step of the p-value from which a stratum's tokens are discoveries.

    ``tokens``: encoding, band, step of all tokens tested, whether they pass the tests of randomness or
    not. The step is the lowest at which the expected false discoveries, all tokens of the stratum
    times the p-value, stay within RATE of the tokens found. The table has a row for each
    encoding and power of the length.
    """
    counts = tokens.groupBy("encoding", "band", "step").agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("encoding", "band")
    above = stratum.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    judged = counts.select("encoding", "band", "step", F.sum("n").over(stratum).alias("all"), F.sum("n").over(above).alias("found"))
    fits = F.col("all") * F.pow(F.lit(10.0), -F.col("step") * STEP) <= RATE * F.col("found")
    return judged.filter(fits).groupBy("encoding", "band").agg(F.min("step").alias("least"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base (ordered base spans), spans (all).

    Spans are kind:start:end in code points, end exclusive, by start and then kind, comma-joined. A found
    random token that touches a base span adds no span. A NULL or empty text has none. Repeated rows
    are scanned each and count each among the tokens tested. Tokens of any length are tested whole. Parts of a
    run that fits no alphabet may lie in one another; each that is found adds a span.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(spans(body, ASSIGN, "assign", 2, 8), spans(body, ACCESS, "access", 0, 16), spans(body, HEX, "hex"))
    tokens = F.transform(candidates(body), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), battery(x["value"]).alias("b")))
    found = stored(docs.select(F.col(doc_id).alias("doc_id"), F.transform(base, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("fixed"), tokens.alias("tokens"))
        .withColumn("row", F.monotonically_increasing_id()), "scanned")
    tested = found.filter(F.size("tokens") > 0).select("row", "fixed", F.explode("tokens").alias("x")).filter("x.b.encoding is not null").select(
        "row", "fixed", "x", F.col("x.b").alias("b"), F.col("x.b.encoding").alias("encoding"), _band(F.col("x.end") - F.col("x.start")).alias("band"),
        _passes(F.col("x.b")).alias("passes"))
    judged = stored(text_chances(tested).withColumn("step", _step(F.col("log_p"))), "judged")
    cuts = thresholds(judged.select("encoding", "band", "step"))
    free = ~F.exists("fixed", lambda y: (y["start"] < F.col("x.end")) & (F.col("x.start") < y["end"]))
    random = (judged.filter(F.col("passes") & free).join(cuts, ["encoding", "band"]).filter(F.col("step") >= F.col("least"))
              .groupBy(F.col("row").alias("of")).agg(F.collect_list(F.struct("x.start", "x.end", "x.kind")).alias("more")))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    tested = found.drop("tokens").join(random, F.col("row") == F.col("of"), "left").withColumn("more", F.coalesce("more", none))

    def number(kind: str) -> Column:
        return F.size(F.filter("fixed", lambda x: x["kind"] == kind)).cast("long")

    return tested.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        _ordered(F.col("fixed")).alias("base"), _ordered(F.concat("fixed", "more")).alias("spans"))
