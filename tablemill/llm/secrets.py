"""Secret scans: fixed patterns, and a battery of randomness tests on long mixed tokens.

A token is a run of 20 or more characters of ``A-Z a-z 0-9 + / _ -`` and the "=" after it, with two or more of
digits, upper and lower case, that touches no pattern match. Its characters give the encoding (hexadecimal,
base 32, 36, 62 or 64) whose alphabet the tests assume. A run that is none as a whole, such as a secret
after a prefix with "_", is cut: at "_" and "-" or at "+" and "/", else at all four; without a piece of 20
characters that has an encoding, the whole run is tested against all its possible characters. The tests:

* chi-squared test of equal use of all letters of the alphabet,
* runs test around the middle of the alphabet,
* serial correlation of neighbouring letters.

The smallest of the three p-values, times three, says how well the token agrees with random text. Tokens of
a similar length are judged together: among those above a threshold the random ones are estimated from the
upper half of the p-values, the others are false discoveries, and the smallest threshold that keeps their
share below ``fdr`` is used. All of it is built from SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Fixed patterns.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

# Whole runs, and their pieces; "=" is padding at the end only, so that KEY=VALUE is cut.
TOKEN = r"[A-Za-z0-9+/_-]{20,}=*"
PIECES = (r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9_-]{20,}=*", r"[A-Za-z0-9]{20,}=*")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base32lower": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base36lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_",
}
SPANS = "array<struct<from:int,upto:int,rank:int,found:string>>"
# Spans that are added one by one, as each step copies what it has.
BLOCK = 128
# Lower ends of the length classes, and the grid of p-value thresholds.
LENGTHS = (20, 24, 32, 48, 64, 128, 512)
GRID = (0.0001, 0.0002, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5)


def _located(text: Column, pattern: str, kind: str, group: int | None = None) -> Column:
    """Array of (from, upto, rank, found) in code points; ``split`` gives what lies between the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.zip_with(
        F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("len"))),
        value,
        lambda s, v: F.struct(s["gap"].alias("gap"), s["len"].alias("len"), v.alias("found")),
    )
    def place(acc: Column, step: Column) -> Column:
        upto = acc["at"] + step["gap"] + step["len"]
        span = F.struct(
            (acc["at"] + step["gap"]).alias("from"), upto.alias("upto"), F.lit(KINDS.index(kind)).alias("rank"), step["found"].alias("found")
        )
        return F.struct(upto.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def joined(blocks: Column) -> Column:
        starts = _before(F.transform(blocks, lambda b: b["at"]), lambda at, n: at + n)
        return F.flatten(F.zip_with(blocks, starts, lambda b, at: F.transform(b["out"], lambda x: _moved(x, at))))

    start = F.struct(F.lit(0).alias("at"), _no_spans().alias("out"))
    blocks = _let(steps, lambda st: F.transform(_block_numbers(st), lambda g: F.aggregate(_block(st, g), start, place)))
    return F.when(text.rlike(pattern), _let(blocks, joined)).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.array().cast(SPANS)


def _moved(span: Column, by: Column) -> Column:
    return F.struct((span["from"] + by).alias("from"), (span["upto"] + by).alias("upto"), span["rank"].alias("rank"), span["found"].alias("found"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _block_numbers(items: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")))


def _block(items: Column, number: Column, more: int = 0) -> Column:
    return F.slice(items, number * BLOCK + 1, F.lit(BLOCK + more))


def _before(values: Column, combine) -> Column:
    """For each whole number what ``combine`` makes of 0 and all numbers before it."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        values, start,
        lambda acc, v: F.struct(combine(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )


def _untouched(tokens: Column, others: Column) -> Column:
    """``tokens``, none inside another, that overlap none of ``others``: a sweep by start, in blocks.

    A token waits until the next span, as one that begins inside it would be that one. A block knows how far
    the spans before it reach, and looks at the first one after it.
    """
    token = lambda x: x["rank"] == KINDS.index("random")
    upto = lambda x: F.when(token(x), 0).otherwise(x["upto"])

    def step(acc: Column, x: Column) -> Column:
        new = F.when(acc["reach"] > x["from"], _no_spans()).otherwise(F.array(x))
        left = F.filter(acc["waiting"], lambda w: w["upto"] <= x["from"])
        return F.struct(
            F.greatest(acc["reach"], upto(x)).alias("reach"),
            F.when(token(x), new).otherwise(left).alias("waiting"),
            F.when(token(x), F.concat(acc["out"], acc["waiting"])).otherwise(acc["out"]).alias("out"),
        )

    def swept(items: Column) -> Column:
        reaches = F.transform(_block_numbers(items), lambda g: F.aggregate(_block(items, g), F.lit(0), lambda m, x: F.greatest(m, upto(x))))

        def block(reach: Column, g: Column) -> Column:
            after = F.get(items, (g + 1) * BLOCK)
            start = F.struct(reach.alias("reach"), _no_spans().alias("waiting"), _no_spans().alias("out"))
            ended = lambda acc: F.concat(acc["out"], F.filter(acc["waiting"], lambda w: after.isNull() | (w["from"] < after["from"])))
            return F.aggregate(_block(items, g, more=1), start, step, ended)

        return F.flatten(F.transform(_before(reaches, F.greatest), block))

    return F.when(F.size(others) == 0, tokens).otherwise(_let(F.array_sort(F.concat(others, tokens)), swept))


def _encoding(token: Column) -> Column:
    """The name in ALPHABETS, or null: ordinary words use one class of characters only, or are joined by signs."""
    digit, upper, lower = token.rlike("[0-9]"), token.rlike("[A-Z]"), token.rlike("[a-z]")
    return (
        F.when(token.rlike("^[0-9a-f]+$") & digit & lower, "hex")
        .when(token.rlike("^[0-9A-F]+$") & digit & upper, "HEX")
        .when(token.rlike("^[A-Z2-7]+=*$") & digit & upper, "base32")
        .when(token.rlike("^[a-z2-7]+=*$") & digit & lower, "base32lower")
        .when(token.rlike("^[0-9A-Z]+=*$") & digit & upper, "base36")
        .when(token.rlike("^[0-9a-z]+=*$") & digit & lower, "base36lower")
        .when(token.rlike("^[0-9A-Za-z]+=*$") & upper & lower, "base62")
        .when(token.rlike("^[0-9A-Za-z+/]+=*$") & upper & lower, "base64")
        .when(token.rlike("^[0-9A-Za-z_-]+=*$") & upper & lower, "base64url")
    )


def _mixed(token: Column) -> Column:
    """Whether two or more of digits, upper and lower case occur."""
    return sum(token.rlike(c).cast("int") for c in ("[0-9]", "[A-Z]", "[a-z]")) >= 2


def _with_tokens(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_token``, an array of (from, upto, rank, found): runs and pieces to be tested, none inside another."""
    coded = lambda spans: F.filter(spans, lambda t: _encoding(t["found"]).isNotNull())
    apart = lambda spans, others: F.filter(spans, lambda t: ~F.exists(others, lambda o: (o["from"] < t["upto"]) & (t["from"] < o["upto"])))
    runs = F.filter(_located(F.col(text), TOKEN, "random"), lambda t: _mixed(t["found"]))
    whole = lambda r: _encoding(r["found"]).isNotNull()
    state = lambda run, whole, tokens: F.struct(run.alias("run"), whole.alias("whole"), tokens.alias("tokens"))
    out = df.withColumn("_runs", F.transform(runs, lambda r: state(r, whole(r), F.when(whole(r), F.array(r)).otherwise(_no_spans()))))

    def cut(pattern: str):
        """Adds a run's pieces of one pattern; no piece crosses from one run to another."""

        def pieces(w: Column) -> Column:
            found = F.transform(coded(_located(w["run"]["found"], pattern, "random")), lambda p: _moved(p, w["run"]["from"]))
            return state(w["run"], w["whole"], F.when(w["whole"], w["tokens"]).otherwise(F.concat(w["tokens"], apart(found, w["tokens"]))))

        return pieces

    for pattern in PIECES:
        out = out.withColumn("_runs", F.transform("_runs", cut(pattern)))
    tested = F.transform("_runs", lambda w: F.when(F.size(w["tokens"]) > 0, w["tokens"]).otherwise(F.array(w["run"])))
    return out.withColumn("_token", F.flatten(tested)).drop("_runs")


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a rational approximation (error below 1e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def with_randomness(df: DataFrame, token: str) -> DataFrame:
    """Adds ``encoding``, ``chi_p``, ``runs_p``, ``serial_p`` and the combined ``p_random`` of a token column.

    Tokens of fewer than two of digits, upper and lower case have nulls.
    """
    body = F.rtrim(F.translate(F.col(token), "=", " "))
    out = df.withColumn("encoding", F.coalesce(_encoding(F.col(token)), F.when(_mixed(F.col(token)), "mixed")))
    alphabet = F.create_map(*(F.lit(x) for pair in ALPHABETS.items() for x in pair))[F.col("encoding")]
    out = out.withColumn("_alpha", alphabet).withColumn(
        "_values", F.when(F.col("encoding").isNotNull(), F.transform(F.split(body, ""), lambda c: F.instr(F.col("_alpha"), c).cast("double")))
    )
    # 0 marks what is outside the alphabet, such as an inner "=".
    out = out.withColumn("_values", F.filter("_values", lambda v: v > 0))
    n, a = F.size("_values").cast("double"), F.length("_alpha").cast("double")
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    out = out.withColumns({
        "_n": n,
        "_a": a,
        "_square": total(F.transform(F.array_distinct("_values"), lambda c: F.pow(F.size(F.filter("_values", lambda x: x == c)).cast("double"), F.lit(2.0)))),
        "_mean": total(F.col("_values")) / n,
    })
    out = out.withColumns({
        "_high": F.transform("_values", lambda v: (v > F.col("_a") / 2).cast("int")),
        "_dev": F.transform("_values", lambda v: v - F.col("_mean")),
    })
    pairs = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    out = out.withColumns({
        "_ones": total(F.transform("_high", lambda v: v.cast("double"))),
        "_runs": 1 + total(F.transform(pairs(F.col("_high")), lambda p: (p["x"] != p["y"]).cast("double"))),
        "_var": total(F.transform("_dev", lambda v: v * v)),
        "_cov": total(F.transform(pairs(F.col("_dev")), lambda p: p["x"] * p["y"])),
    })
    n, df_chi = F.col("_n"), F.col("_a") - 1
    chi = F.col("_a") / n * F.col("_square") - n
    chi_z = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df_chi) - (1 - 2 / (9 * df_chi))) / F.sqrt(2 / (9 * df_chi))
    zeros = n - F.col("_ones")
    product = 2 * F.col("_ones") * zeros
    runs_mean = product / n + 1
    runs_var = product * (product - n) / (n * n * (n - 1))
    runs_p = F.when(runs_var > 0, 2 * _tail(F.abs(F.col("_runs") - runs_mean) / F.sqrt(F.when(runs_var > 0, runs_var)))).otherwise(0.0)
    serial_z = (F.col("_cov") / F.when(F.col("_var") > 0, F.col("_var")) + 1 / n) * F.sqrt(n)
    out = out.withColumns({
        "chi_p": F.when(F.col("encoding").isNotNull(), _tail(chi_z)),
        "runs_p": F.when(F.col("encoding").isNotNull(), runs_p),
        "serial_p": F.when(F.col("encoding").isNotNull(), F.coalesce(2 * _tail(F.abs(serial_z)), F.lit(0.0))),
    })
    p = F.least(F.lit(1.0), 3 * F.least("chi_p", "runs_p", "serial_p"))
    out = out.withColumn("p_random", F.when(F.col("encoding").isNotNull(), p))
    return out.drop("_alpha", "_values", "_n", "_a", "_square", "_mean", "_high", "_dev", "_ones", "_runs", "_var", "_cov")


def _class(length: Column) -> Column:
    return sum((length >= low).cast("int") for low in LENGTHS) - 1


def thresholds(tokens: DataFrame, fdr: float) -> dict[int, float]:
    """Smallest threshold per length class that keeps the estimated false discoveries below ``fdr``.

    The counts of a class are one row, so what reaches the driver does not grow with the data.
    """
    counts = tokens.where("p_random IS NOT NULL").groupBy(_class(F.length("found")).alias("class")).agg(
        *(F.sum((F.col("p_random") > t).cast("long")).alias(f"t{k}") for k, t in enumerate(GRID))
    )
    out = {}
    for row in counts.collect():
        random_tokens = row[f"t{len(GRID) - 1}"] / (1 - GRID[-1])
        for k, t in enumerate(GRID):
            false_share = 1 - random_tokens * (1 - t) / row[f"t{k}"] if row[f"t{k}"] else 0.0
            out[row["class"]] = t
            if false_share <= fdr:
                break
    return out


def scan_secrets(docs: DataFrame, fdr: float = 0.1, carry: bool = False) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs`` (``doc_id, text``); with ``carry`` also the row as ``doc``.

    ``spans`` is an array of (from, upto, rank): code points, end exclusive, rank indexes KINDS, sorted.
    A null or empty text has no span; repeated rows are scanned each on their own; ties in ``from`` are
    ordered by rank. Other columns are ignored; an empty table gives an empty result. Work grows with the length of a text
    and its number of spans, save inside a single run, whose pieces are compared with each other. Stores spans and tested tokens in one job, then applies
    the thresholds.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")] if carry else []
    keep = ["doc"] if carry else []
    base = docs.select("doc_id", *row, text.alias("_text")).withColumns({
        "_assign": F.filter(_located(F.col("_text"), ASSIGN, "assign", 2), lambda s: F.length(s["found"]) >= 8),
        "_access": _located(F.col("_text"), ACCESS, "access"),
        "_hex": _located(F.col("_text"), HEX, "hex"),
    })
    base = _with_tokens(base, "_text")
    base = base.withColumn("_base", F.concat("_assign", "_access", "_hex"))
    free = _untouched(F.col("_token"), F.col("_base"))
    narrow = F.transform("_base", lambda s: F.struct(s["from"].alias("from"), s["upto"].alias("upto"), s["rank"].alias("rank")))
    stored = materialize(
        base.select("doc_id", *keep, narrow.alias("_base"), free.alias("_token"), F.monotonically_increasing_id().alias("_row")),
        "spans",
    )
    tokens = stored.select("_row", F.explode("_token").alias("_t")).select("_row", "_t.*")
    tested = materialize(with_randomness(tokens, "found"), "tokens")
    limits = thresholds(tested, fdr)
    limit = F.lit(2.0)
    for k, t in limits.items():
        limit = F.when(_class(F.length("found")) == k, F.lit(t)).otherwise(limit)
    secret = (
        tested.where(F.col("p_random") > limit)
        .groupBy(F.col("_row").alias("_hit"))
        .agg(F.collect_list(F.struct("from", "upto", "rank")).alias("_random"))
    )
    joined = stored.join(secret, F.col("_row") == F.col("_hit"), "left")
    empty = F.array().cast("array<struct<from:int,upto:int,rank:int>>")
    return joined.select("doc_id", *keep, F.array_sort(F.concat("_base", F.coalesce("_random", empty))).alias("_s")).select(
        "doc_id", *keep,
        F.array_sort("_s", lambda a, b: F.when(a["from"] != b["from"], a["from"] - b["from"]).otherwise(a["rank"] - b["rank"])).alias("spans"),
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["from"].cast("string"), s["upto"].cast("string"))),
        ",",
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", fdr: float = 0.1) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` and ``n_chars`` counted anew.

    Overlapping spans become one mark. A null text stays null.
    """
    scanned = scan_secrets(docs, fdr, carry=True)
    old = F.col("doc")["text"]
    # Cut the text between spans; ``at`` is the end of what has been written or covered.
    built = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["upto"]).alias("at"),
            F.when(s["from"] >= acc["at"], F.concat(acc["out"], F.substr(old, acc["at"] + 1, s["from"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substr(old, acc["at"] + 1)),
    )
    hit = F.size("spans") > 0
    out = scanned.withColumn("_clean", F.when(hit, built).otherwise(old))
    fields = {c: F.col("doc")[c] for c in docs.columns} | {"text": F.col("_clean")}
    if "n_chars" in fields:
        kind = dict(docs.dtypes)["n_chars"]
        fields["n_chars"] = F.when(hit, F.length("_clean").cast(kind)).otherwise(fields["n_chars"])
    return out.select(*(column.alias(name) for name, column in fields.items()))
