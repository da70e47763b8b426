"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests tells from text.

Every distinct string of 16 or more letters, digits, + / _ - (with = at its end) is a candidate.
Its encoding is inferred from the characters it has. Three tests ask whether it looks random in
that encoding: chi-squared for a uniform alphabet, a runs test about the alphabet's middle, and
lag-one serial correlation. A string that fails one isn't reported.

Those that remain must also be unlike text. Under text, letters repeat far more often than in a
uniform alphabet (the count behind chi-squared), and lower case, upper case and digits seldom
alternate (the runs of character classes); both tail bounds grow with the string's length, and
Fisher's method combines them. The Benjamini-Hochberg rule then bounds the share of false
discoveries separately in each class of lengths, so that the many short candidates don't hide
behind the few long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmill.llm.arrays import let, running_totals
from cartmill.llm.store import fresh, keep, without

# The patterns, and the characters a match or its value must have at least.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
#: A match that starts at the first AKIA, or the first digit, is the longest there: shorter ones
#: fail, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order they are tried: what the string may hold, and the alphabet.
ENCODINGS = (
    ("[0-9]+", DIGITS),
    ("[0-9a-f]+", DIGITS + "abcdef"),
    ("[0-9A-F]+", DIGITS + "ABCDEF"),
    ("[a-z]+", LOWER),
    ("[A-Z]+", UPPER),
    ("[A-Z2-7]+", UPPER + "234567"),
    ("[0-9a-z]+", DIGITS + LOWER),
    ("[0-9A-Z]+", DIGITS + UPPER),
    (".+", UPPER + LOWER + DIGITS + "+/_-"),
)
#: Each test rejects a random string with probability 0.0003 (two-sided normal).
REJECT_Z = 3.6
#: Of text: chance that two letters agree, that three do, and that the class changes.
SAME_TWO, SAME_THREE, CHANGE = 0.0655, 0.0055, 0.1
#: Bound on the share of false discoveries, and where the classes of lengths begin.
FALSE_SHARE = 0.01
LENGTHS = (16, 24, 32, 64)
#: -ln p is counted in steps of a quarter up to 100.
STEPS, MOST = 4, 400


def _spans(text: str, pattern: str, kind: str, value: int = 0) -> str:
    """SQL for all matches as {start, end, kind, match}; with `value`, those whose group 2 is as long."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    match = f"regexp_extract_all({text}, '{quoted}', 0)"
    group = f"regexp_extract_all({text}, '{quoted}', 2)" if value else "m"
    steps = "transform(m, (x, i) -> CAST(length(p[i]) + length(x) AS BIGINT))"
    spans = f"""transform(m, (x, i) -> struct(b[i] + length(p[i]) AS start, b[i] + length(p[i]) + length(x) AS end,
        '{kind}' AS kind, x AS match, g[i] AS value))"""
    all_of = let("p", f"split({text}, '{quoted}', -1)", let("g", group, let("b", running_totals(steps), spans)))
    found = let("m", match, f"if(size(m) = 0, NULL, {all_of})")
    least = f"length(s.value) >= {value}" if value else "true"
    kept = f"transform(filter({found}, s -> {least}), s -> struct(s.start, s.end, s.kind, s.match))"
    return kept


def battery(tokens: DataFrame) -> DataFrame:
    """`tokens` (token) with chi_z, runs_z, serial_z and log_p, the bound on ln P under text.

    Tokens are matches of CANDIDATE; for null, empty or one-character tokens the results are null.
    Tests take the time of a token's length times its alphabet's size, at most 66.
    """
    body = F.regexp_replace("token", "=+$", "")
    alphabet = F.coalesce(*[F.when(body.rlike(f"^{p}$"), F.lit(a)) for p, a in ENCODINGS])
    rows = tokens.select("token", body.alias("body"), alphabet.alias("alphabet")).selectExpr(
        "token",
        "CAST(length(body) AS DOUBLE) AS n",
        "CAST(length(alphabet) AS DOUBLE) AS k",
        "transform(split(body, ''), c -> locate(c, alphabet)) AS v",
        """size(split(body, '(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[+/_-])(?=[^+/_-])', -1)) - 1
           AS changes""",
    )
    sums = rows.selectExpr(
        "*",
        """CAST(aggregate(sequence(1, CAST(k AS INT)), 0L, (a, s) ->
             a + power(size(filter(v, x -> x = s)), 2)::BIGINT) AS DOUBLE) AS squares""",
        "aggregate(v, 0D, (a, x) -> a + x) / n AS mean",
        "CAST(size(filter(v, x -> x * 2 > k + 1)) AS DOUBLE) AS high",
        "CAST(1 + size(filter(v, (x, i) -> i > 0 AND (x * 2 > k + 1) <> (v[greatest(i - 1, 0)] * 2 > k + 1))) AS DOUBLE) AS runs",
    ).selectExpr(
        "*",
        "aggregate(v, 0D, (a, x) -> a + (x - mean) * (x - mean)) AS spread",
        """aggregate(transform(v, (x, i) -> if(i = 0, 0D, (x - mean) * (v[greatest(i - 1, 0)] - mean))),
             0D, (a, x) -> a + x) AS lagged""",
        "2 * high * (n - high) / n AS even",
    )
    tested = sums.selectExpr(
        "token",
        "n",
        "k",
        "changes",
        "squares",
        "(k / n * squares - n - (k - 1)) / sqrt(2 * (k - 1)) AS chi_z",
        "CASE WHEN high = 0 OR high = n THEN 99D ELSE (runs - 1 - even) / sqrt(greatest(even * (even - 1) / (n - 1), 0.01)) END AS runs_z",
        "CASE WHEN spread = 0 THEN 99D ELSE lagged / spread * sqrt(n) END AS serial_z",
        f"""(squares - n - n * (n - 1) * {SAME_TWO})
            / sqrt(2 * n * n * {SAME_TWO} + 4 * n * n * n * {SAME_THREE - SAME_TWO**2}) AS text_z""",
        "least(greatest(changes / (n - 1), 1e-9), 1 - 1e-9) AS rate",
    )
    # Chernoff bounds of the two tails, then Fisher's method: P = xy (1 - ln xy).
    bounds = tested.selectExpr(
        "*",
        "if(text_z < 0, -0.69 - text_z * text_z / 2, 0D) AS same_p",
        f"""if(rate > {CHANGE}, -(n - 1) * (rate * ln(rate / {CHANGE})
              + (1 - rate) * ln((1 - rate) / {1 - CHANGE})), 0D) AS change_p""",
    )
    return bounds.selectExpr(
        "token", "n", "chi_z", "runs_z", "serial_z",
        "same_p + change_p + ln(1 - same_p - change_p) AS log_p",
    )


def discoveries(tokens: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """The distinct tokens that pass the tests and the false-discovery bound of their length class.

    Null tokens are passed over; an empty frame has none. The distinct strings and their scores
    are written, so that each string is tested once, whatever is asked of the scores.
    """
    strings = keep(tokens.where("token IS NOT NULL").distinct(), "strings")
    scored = battery(strings).select(
        "token",
        F.greatest(*[F.when(F.col("n") >= x, F.lit(x)) for x in LENGTHS]).alias("class"),
        F.least((-F.col("log_p") * STEPS).cast("int"), F.lit(MOST)).alias("step"),
        ((F.abs("chi_z") < REJECT_Z) & (F.abs("runs_z") < REJECT_Z) & (F.abs("serial_z") < REJECT_Z)).alias("random"),
    )
    scored = keep(scored, "scored")
    # A histogram of at most LENGTHS x MOST cells; random ones alone are discoveries.
    cells = scored.where("class IS NOT NULL").groupBy("class", "step").agg(
        F.count("*").alias("all"), F.count_if("random").alias("found")
    )
    limits = cells.selectExpr(
        "class", "step",
        "sum(all) OVER (PARTITION BY class) AS m",
        "sum(found) OVER (PARTITION BY class ORDER BY step DESC) AS so_far",
    ).where(F.expr(f"so_far > 0 AND m * exp(-step / {STEPS}D) <= {share} * so_far")).groupBy("class").agg(
        F.min("step").alias("least")
    )
    return scored.where("random").join(F.broadcast(limits), "class").where("step >= least").select("token")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without their text, with base and spans: arrays of {start, end, kind}.

    Both are in order of start, then kind as KINDS lists them; offsets are code points, the end
    exclusive. `base` has the patterns' matches, leftmost and not overlapping within a kind;
    `spans` also has the random strings that lie in none of them. A null text is empty and has
    none. Rows are kept as they are, repeated ones too; input columns base and spans are
    replaced. An empty frame gives no rows.
    """
    rows = without(docs, "base", "spans")
    body, base, cands, rid, added = fresh(rows, "body", "base", "cands", "rid", "added")
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    order = f"""(x, y) -> CASE WHEN x.start <> y.start THEN if(x.start < y.start, -1, 1)
        ELSE CAST(array_position(array({kinds}), x.kind) - array_position(array({kinds}), y.kind) AS INT) END"""
    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, kind: STRING, match: STRING>>)"
    parts = [
        f"coalesce({_spans(body, p, k, v)}, {none})"
        for p, k, v in ((ASSIGN, "assign", ASSIGN_VALUE), (ACCESS, "access", 0), (HEX, "hex", 0))
    ]
    others = [f"`{c}`" for c in rows.columns if c != text]
    read = rows.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit(""))).selectExpr(
        *others,
        f"array_sort(concat({', '.join(parts)}), {order}) AS {base}",
        f"coalesce({_spans(body, CANDIDATE, 'random')}, {none}) AS {cands}",
    )
    found = keep(
        read.selectExpr(
            *others,
            f"transform({base}, s -> struct(s.start, s.end, s.kind)) AS {base}",
            f"filter({cands}, c -> NOT exists({base}, b -> b.start <= c.start AND c.end <= b.end)) AS {cands}",
        ).withColumn(rid, F.monotonically_increasing_id()),
        "secrets",
    )
    strings = found.select(rid, F.explode(cands).alias("s"))
    hits = (
        strings.join(discoveries(strings.select(F.col("s.match").alias("token"))), F.col("s.match") == F.col("token"))
        .groupBy(rid)
        .agg(F.collect_list(F.struct("s.start", "s.end", "s.kind")).alias(added))
    )
    return found.join(hits, rid, "left").selectExpr(
        *others,
        f"{base} AS base",
        f"if({added} IS NULL, {base}, array_sort(concat({base}, {added}), {order})) AS spans",
    )


def listing(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
