"""Secret scans: patterns, and strings that a battery of randomness tests cannot tell from random ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in the order of their listing, with the group that
# must have at least so many characters.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
KINDS = (*BASE, "random")

# A string that may be random: its characters, and how many at least.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"

# Encodings from the narrowest alphabet to the widest; a candidate belongs to the first that covers it.
ENCODINGS = {
    "hex": ("[0-9a-f]+|[0-9A-F]+", 16),
    "base32": ("[A-Z2-7]+|[a-z2-7]+", 32),
    "base36": ("[0-9a-z]+|[0-9A-Z]+", 36),
    "base64": ("[A-Za-z0-9+/_-]+", 64),
}

# The p-values from which on strings may count as random, the smallest admissible one is taken.
CUTS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)

# The share of strings taken that may be ordinary ones.
FALSE_DISCOVERIES = 0.1

# Values in a block of a running sum.
RUN = 256

# Above this p-value all strings are taken for random when their number is estimated.
SURELY = 0.5


def _run(values: str, step: str, zero: str) -> str:
    """SQL for the running results of ``step`` over acc and x, for short arrays: each step copies what came before."""
    return (
        f"aggregate({values}, struct({zero} AS at, CAST(array() AS array<bigint>) AS run), (s, x) -> "
        f"struct({step.format(acc='s.at', x='x')} AS at, concat(s.run, array({step.format(acc='s.at', x='x')})) AS run), s -> s.run)"
    )


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body``, in which ``name`` stands for ``value``, evaluated once.

    A column that a lambda function mentions may be put in its place by the optimizer, and is then
    evaluated for each element; a variable is not.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def with_running(rows: DataFrame, name: str, values: str, step: str = "{acc} + {x}") -> DataFrame:
    """Add the array ``name``: running sums, or other results of ``step`` from 0 on, of an array of bigint.

    Taken in blocks of ``RUN`` values, then over the blocks, so that the work is near linear in the length.
    """
    block = _run(f"slice(v, b * {RUN} + 1, {RUN})", step, "0L")
    cut = f"CASE WHEN size(v) > 0 THEN transform(sequence(0, (size(v) - 1) DIV {RUN}), b -> {block}) ELSE CAST(array() AS array<array<bigint>>) END"
    before = f"concat(array(0L), {_run('transform(blocks, r -> element_at(r, -1))', step, '0L')})"
    placed = f"zip_with(blocks, slice({before}, 1, size(blocks)), (r, t) -> transform(r, x -> {step.format(acc='t', x='x')}))"
    return rows.withColumn(name, F.expr(f"flatten({let('blocks', let('v', values, cut), placed)})"))


def _matches(docs: DataFrame, text: Column, name: str, pattern: str, group: int) -> DataFrame:
    """Add ``_s_<name>``: all leftmost matches that do not overlap, as (start, end, string of the group).

    The ends are running sums of the lengths of the matches and of what lies between them.
    """
    none = F.array().cast("array<string>")
    hit = F.rlike(text, F.lit(pattern))

    def all_of(g: int) -> Column:
        return F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(g))).otherwise(none)

    found, parts, bodies, ends, spans = f"_m_{name}", f"_p_{name}", f"_g_{name}", f"_e_{name}", f"_s_{name}"
    parted = F.when(hit, F.split(text, pattern, -1)).otherwise(none)
    out = docs.withColumns({found: all_of(0), parts: parted, **({bodies: all_of(group)} if group else {})})
    lengths = f"zip_with({found}, slice({parts}, 1, size({found})), (m, p) -> CAST(length(p) + length(m) AS bigint))"
    out = with_running(out, ends, lengths)
    zipped = f"arrays_zip({found}, {ends}{f', {bodies}' if group else ''})"
    placed = f"struct(CAST(z.{ends} - length(z.{found}) AS int) AS start, CAST(z.{ends} AS int) AS end, z.{bodies if group else found} AS body)"
    return out.withColumn(spans, F.expr(f"transform({zipped}, z -> {placed})")).drop(found, parts, bodies, ends)


def overlaps(r: str, base: str, reach: str) -> str:
    """SQL: whether span ``r`` overlaps one of ``base``, sorted by start, with the largest end so far in ``reach``.

    The number of spans that start before the end of ``r`` is found bit by bit.
    """
    before = (
        f"aggregate(sequence(30, 0, -1), 0, (k, b) -> CASE WHEN k + shiftleft(1, b) <= size({base}) "
        f"AND {base}[k + shiftleft(1, b) - 1].start < {r}.end THEN k + shiftleft(1, b) ELSE k END)"
    )
    return f"coalesce(get({reach}, {before} - 1) > {r}.start, false)"


def normal_two_sided(z: str) -> str:
    """SQL for the probability that a standard normal is further from 0 than ``z``; error below 2e-7."""
    x = f"(abs({z}) / sqrt(2.0D))"
    t = f"(1.0D / (1.0D + 0.3275911D * {x}))"
    poly = f"((((1.061405429D * {t} - 1.453152027D) * {t} + 1.421413741D) * {t} - 0.284496736D) * {t} + 0.254829592D) * {t}"
    return f"(({poly}) * exp(-{x} * {x}))"


def battery(strings: str) -> str:
    """SQL: the array of (start, end, body) ``strings`` with encoding, n and p added to each.

    ``p`` says how well a string passes for a random one of its encoding. Three
    tests look at the characters' places in the alphabet, two-sided, with moments of
    uniform strings: the chi-squared statistic of the counts, the number of runs above
    and below the middle of the alphabet, and the correlation of neighbours. ``p`` is
    that of the smallest of the three, as of three independent ones. Strings without
    a letter or a digit are no candidates and have a NULL encoding.
    """
    digits = "0123456789"
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kind = " ".join(f"WHEN r.s RLIKE '^({rx})$' THEN '{name}'" for name, (rx, _) in ENCODINGS.items())
    size = " ".join(f"WHEN '{name}' THEN {k}.0D" for name, (_, k) in ENCODINGS.items())
    place = (
        "CASE r.encoding "
        f"WHEN 'hex' THEN instr('{digits}abcdef', lower(c)) - 1 "
        f"WHEN 'base32' THEN instr('{lower}234567', lower(c)) - 1 "
        f"WHEN 'base36' THEN instr('{digits}{lower}', lower(c)) - 1 "
        f"ELSE instr('{upper}{lower}{digits}+/', translate(c, '-_', '+/')) - 1 END"
    )
    counts = "sequence(0, CAST(r.k AS int) - 1), 0.0D, (acc, v) -> acc + power(size(filter(r.x, x -> x = v)), 2)"
    lag = "sequence(1, r.n - 1), 0.0D, (acc, i) -> acc + (r.x[i] - r.mean) * (r.x[i - 1] - r.mean)"
    runs = "sequence(1, r.n - 1), 1.0D, (acc, i) -> acc + CASE WHEN (r.x[i] >= r.k / 2) = (r.x[i - 1] >= r.k / 2) THEN 0.0D ELSE 1.0D END"
    expected = "(2.0D * r.high * (r.n - r.high) / r.n + 1)"
    variance = f"({expected} - 1) * ({expected} - 2) / (r.n - 1)"
    least = ", ".join(normal_two_sided(f"r.z{i}") for i in (1, 2, 3))
    steps = {
        "s": "trim(TRAILING '=' FROM r.body)",
        "encoding": f"CASE WHEN r.s RLIKE '[0-9]' AND r.s RLIKE '[A-Za-z]' THEN CASE {kind} END END",
        "n": "length(r.s)",
        "k": f"CASE r.encoding {size} END",
        "x": f"transform(split(r.s, ''), c -> {place})",
        "mean": "aggregate(r.x, 0.0D, (acc, x) -> acc + x) / r.n",
        "squares": f"aggregate({counts})",
        "spread": "aggregate(r.x, 0.0D, (acc, x) -> acc + (x - r.mean) * (x - r.mean))",
        "high": "CAST(size(filter(r.x, x -> x >= r.k / 2)) AS double)",
        "runs": f"aggregate({runs})",
        "lag": f"aggregate({lag})",
        "variance": variance,
        "z1": "((r.k / r.n * r.squares - r.n) - (r.k - 1)) / sqrt(2.0D * (r.k - 1) * (r.n - 1) / r.n)",
        "z2": f"CASE WHEN r.variance <= 0 THEN 9.0D ELSE (r.runs - {expected}) / sqrt(r.variance) END",
        "z3": "CASE WHEN r.spread <= 0 THEN 9.0D ELSE (r.lag / r.spread + 1.0D / r.n) * sqrt(CAST(r.n AS double)) END",
        "p": f"CASE WHEN r.encoding IS NOT NULL THEN round(1.0D - power(1.0D - least({least}, 1.0D), 3), 9) END",
    }
    fields, out = ["start", "end", "body"], strings
    for name, step in steps.items():
        carried = ", ".join(f"r.{f} AS {f}" for f in fields)
        out = f"transform({out}, r -> struct({carried}, {step} AS {name}))"
        fields.append(name)
    return f"transform({out}, r -> struct(r.start AS start, r.end AS end, r.encoding AS encoding, r.n AS n, r.p AS p))"


def length_class(n: str = "n") -> str:
    """SQL for the class of lengths within which strings are compared: powers of two, 10 for all beyond."""
    return f"CAST(least(floor(log2({n})), 10) AS int)"


def cuts(tested: DataFrame) -> dict[tuple[str, int], float]:
    """The p-value from which on strings count as random, per encoding and class of lengths.

    Long strings are told apart well, short ones badly, so each class has its own
    control. Random strings have p-values spread evenly; their number is estimated
    from those above ``SURELY``. What a cut takes beyond its even share is ordinary text
    taken for random; the smallest cut at which this is at most ``FALSE_DISCOVERIES`` of
    all taken is used, and none if there is no such cut. At most 4 x 7 classes with
    one count per cut come back from one aggregate.
    """
    taken = [F.count(F.when(F.col("p") >= c, 1)).alias(f"c{i}") for i, c in enumerate(CUTS)]
    rows = (
        tested.filter("encoding IS NOT NULL")
        .groupBy("encoding", F.expr(length_class()).alias("class"))
        .agg(*taken, F.count(F.when(F.col("p") >= SURELY, 1)).alias("sure"))
        .collect()
    )
    found = {}
    for row in rows:
        random = row["sure"] / (1 - SURELY)
        for i, c in enumerate(CUTS):
            n = row[f"c{i}"]
            if n and n - random * (1 - c) <= FALSE_DISCOVERIES * n:
                found[row["encoding"], row["class"]] = c
                break
    return found


def accepted(limits: dict[tuple[str, int], float], r: str) -> str:
    """SQL: whether the tested string ``r`` counts as random."""
    cases = [
        f"({r}.encoding = '{encoding}' AND {length_class(f'{r}.n')} = {size} AND {r}.p >= {cut}D)"
        for (encoding, size), cut in sorted(limits.items())
    ]
    return " OR ".join(cases) or "false"


def with_candidates(rows: DataFrame) -> DataFrame:
    """Add ``random``: the tested candidate strings of each text."""
    found = _matches(rows, F.col("text"), "random", CANDIDATE, 0)
    return found.withColumn("random", F.expr(battery("_s_random"))).drop("_s_random")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans), one row per row of ``docs``.

    ``base`` and ``spans`` are arrays of (start, end, kind) in code points, end
    exclusive, ordered by start and then by kind in the order of ``KINDS``; ``spans`` also
    holds the strings that the randomness tests take for random and that overlap
    no base span. NULL and empty texts have no spans. Rows stand for themselves, also
    repeated ones.

    The work grows with the length of a text and not with the square of its matches. The texts are read twice, once for the statistics and once for the result, and
    moved by neither.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    limits = cuts(with_candidates(rows.select("text")).select(F.explode("random").alias("r")).select("r.*"))
    out = with_candidates(rows)
    for i, (name, (pattern, group, least)) in enumerate(BASE.items()):
        kept = f"transform(filter(_s_{name}, s -> length(s.body) >= {least}), s -> struct(s.start AS start, s.end AS end, {i} AS kind))"
        out = _matches(out, F.col("text"), name, pattern, group).withColumn(f"_s_{name}", F.expr(kept))
    out = out.withColumn("base", F.array_sort(F.concat(*[F.col(f"_s_{k}") for k in BASE])))
    out = with_running(out, "_reach", "transform(base, b -> CAST(b.end AS bigint))", "greatest({acc}, {x})")
    free = f"filter(random, r -> ({accepted(limits, 'r')}) AND NOT {overlaps('r', 't.base', 't.reach')})"
    added = let("t", "struct(base AS base, _reach AS reach)", free)
    added = f"transform({added}, r -> struct(r.start AS start, r.end AS end, {len(BASE)} AS kind))"
    return (
        out.withColumn("spans", F.array_sort(F.expr(f"concat(base, {added})")))
        .select("doc_id", "base", "spans")
    )


def written(spans: str) -> Column:
    """The spans as ``kind:start:end``, joined by commas."""
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat({kinds}[s.kind], ':', s.start, ':', s.end)), ',')")
