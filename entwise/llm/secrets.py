"""Secrets in texts: fixed patterns, and high-entropy strings by sliding windows.
DataFrame and SQL functions only; no row leaves its partition.

Positions: splitting a text at a pattern gives what lies between its matches, so
the lengths of those pieces and of the matches add up to the matches' places.

Entropy: candidates are long runs of a character class. A window of ``WINDOW``
characters slides over each; counts per character, and the sum of c * log2(c)
over them, change by the character that comes and the one that goes, so a step
costs the same for any window. Where the window's Shannon entropy, log2(WINDOW) -
sum / WINDOW, reaches the class's threshold, the run from the first to the last
such window is a span. Candidates on the allow-list are not looked at: strings
without a digit (long words) or without a letter (numbers), UUIDs, strings with
placeholder words, and strings of very few different characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20

# FIXED VALUES: the base kinds' patterns and least lengths, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of fewer never counts, and runs are found whole
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]

#: class: (candidates, alphabet, bits a character needed in a window)
CLASSES = {
    "entropy_hex": (r"(?<![0-9A-Za-z])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])",
                    "0123456789abcdef", 3.0),
    "entropy_base64": (r"(?<![0-9A-Za-z+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[0-9A-Za-z+/_-]{20,}",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.8),
}
ALLOWED = (r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
           r"|example|sample|placeholder|dummy|x{6}|0{8}|1{8}|(?:0123456789|abcdefghij)")

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _places(text: Column, pattern: str, group: int, kind: int, least: int) -> Column:
    """Spans of the pattern's matches, left to right without overlap, whose
    ``group`` has ``least`` characters."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    empty = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        found = F.when(F.length(x["value"]) >= least, F.array(span)).otherwise(empty)
        return F.struct(end.alias("at"), F.concat(acc["out"], found).alias("out"))

    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(pieces, start, step, lambda acc: acc["out"])) \
        .otherwise(empty)


def _candidates(text: Column, pattern: str) -> Column:
    """array<struct<start, value>> of the pattern's matches."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    kind = "array<struct<start:int,value:string>>"
    empty = F.array().cast(kind)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        found = F.when(x["hit"].isNotNull(), F.array(F.struct(begin.alias("start"), x["hit"].alias("value")))) \
            .otherwise(empty)
        return F.struct((begin + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
                        F.concat(acc["out"], found).alias("out"))

    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(
        pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])).otherwise(empty)


def _clogc(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _hot_run(value: Column, alphabet: str, bits: float) -> Column:
    """struct<first, last>: places (from 0) of the first and the last window of
    ``value`` whose entropy reaches ``bits``; first is -1 if there is none."""
    n = len(alphabet)
    letters = value if len(set(alphabet)) != len({c.lower() for c in alphabet}) else F.lower(value)
    ids = F.transform(F.split(letters, ""), lambda c: F.instr(F.lit(alphabet), c))  # 0: not in the class
    steps = F.arrays_zip(
        ids.alias("come"),
        F.concat(F.array_repeat(F.lit(0), WINDOW), ids).alias("go"),
        F.sequence(F.lit(1), F.length(value)).alias("nth"))
    zero = F.struct(F.array_repeat(F.lit(0), n + 1).alias("counts"), F.lit(0.0).alias("sum"),
                    F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        come, go, nth = x["come"], x["go"], x["nth"]
        c_in, c_out = acc["counts"][come], acc["counts"][go]
        gone = F.when((go > 0) & (go != come), _clogc(c_out - 1) - _clogc(c_out)).otherwise(F.lit(0.0))
        came = F.when(go != come, _clogc(c_in + 1) - _clogc(c_in)).otherwise(F.lit(0.0))
        total = acc["sum"] + gone + came
        counts = F.transform(acc["counts"], lambda c, i: c + F.when(i == come, 1).otherwise(0)
                             - F.when((i == go) & (go > 0), 1).otherwise(0))
        hot = (nth >= WINDOW) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= bits)
        at = nth - WINDOW
        return F.when(nth.isNull(), acc).otherwise(F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.when(hot & (acc["first"] < 0), at).otherwise(acc["first"]).alias("first"),
            F.when(hot, at).otherwise(acc["last"]).alias("last")))

    return F.aggregate(steps, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _entropy_spans(found: Column, kind: str) -> Column:
    _, alphabet, bits = CLASSES[kind]
    looked = F.filter(found, lambda c: ~F.rlike(c["value"], F.lit(ALLOWED)))
    runs = F.transform(looked, lambda c: F.struct(c["start"].alias("at"), _hot_run(c["value"], alphabet, bits).alias("r")))
    return F.transform(
        F.filter(runs, lambda x: x["r"]["first"] >= 0),
        lambda x: F.struct((x["at"] + x["r"]["first"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                           (x["at"] + x["r"]["last"] + WINDOW).alias("end"))).cast(SPAN)


def _aside(docs: DataFrame, own: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns that have names of our own renamed, and the names."""
    names = {}
    for c in docs.columns:
        if c in own:
            names[c] = f"_kept_{c}"
            while names[c] in docs.columns:
                names[c] += "_"
    return docs.withColumnsRenamed(names), names


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (text, any other columns) with ``base`` and ``secrets``: arrays of
    struct<start, kind, end> in code points, end exclusive, ordered by start, then
    kind (a number in ``KINDS``). ``secrets`` holds the base spans and the
    high-entropy spans that do not lie inside a base one.

    A null or empty text has none. Other columns are kept as they are, except
    that columns named ``base`` or ``secrets`` are replaced.
    """
    columns = [c for c in docs.columns if c not in ("base", "secrets")]
    docs, names = _aside(docs, ["_added", *[f"_{kind}" for kind in CLASSES]])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(_places(text, ASSIGN, 2, 0, LEAST["assign"]), _places(text, ACCESS, 0, 1, LEAST["access"]),
                    _places(text, HEX, 0, 2, LEAST["hex"]))
    found = docs.withColumns({"base": F.sort_array(base)} | {
        f"_{kind}": _candidates(text, pattern) for kind, (pattern, _, _) in CLASSES.items()})
    added = F.concat(*[_entropy_spans(F.col(f"_{kind}"), kind) for kind in CLASSES])
    found = found.withColumn("_added", F.when(
        F.size("_entropy_hex") + F.size("_entropy_base64") > 0, added).otherwise(F.array().cast(SPAN)))
    new = F.filter("_added", lambda a: ~F.exists("base", lambda b: (b["start"] <= a["start"]) & (b["end"] >= a["end"])))
    return found.withColumn("secrets", F.sort_array(F.concat("base", new))).select(
        *[F.col(names.get(c, c)).alias(c) for c in columns], "base", "secrets")


def written(spans: str) -> Column:
    """The spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _counted(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    found = find_secrets(docs.select("doc_id", "text"))
    return found.select("doc_id", *[_counted(k).alias(f"n_{k}") for k in LEAST],
                        F.sha2(written("base"), 256).alias("base_sha256"), written("secrets").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; overlapping
    secrets become one mark. Texts without a secret, and nulls, are unchanged, as
    are all other columns, whatever their names."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text").cast("string")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))) \
            .otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("secrets", zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    renamed, names = _aside(docs, ["base", "secrets"])
    found = find_secrets(renamed).withColumn("text", F.when(F.size("secrets") > 0, clean).otherwise(text))
    return found.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
