"""Quality rules: lines that many documents of a host share, counted across documents.

Only column functions run here. Each line is normalised (blank runs to one
blank, ends trimmed, lower case) and hashed; for each host the documents holding
it are counted. Lines above the host's limit are a table that the lines of each
text meet by host and hash. A line above the limit is removed, and a document
left with too few of its words is rejected. A line that only copies of one text hold
is no boilerplate and stays.

Results, row by row: null or empty text has no words, fails the base rules and
is not kept. A null host is a host of its own, the empty name. Null or repeated
ids and repeated rows change nothing but the counts they add to. An empty table
gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textsieve.llm.common import let, unused
from textsieve.staging import write_staged

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A line is boilerplate in more different documents of its host than this many, however
#: large the host is; a caller may ask for a share of the host's documents besides.
LINE_DOCUMENTS = 10
LINE_PERCENT = 0
#: A document is depleted if fewer than so many in a hundred of its words are left.
LEAST_LEFT_PERCENT = 30
#: Columns of text_keys.
KEYS = ("k1", "k2")


def repeated_words(words: Column) -> Column:
    """Words in windows of three found twice or more in the array, first ones included."""
    windows = F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.struct(
                F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")
            ),
        ),
    )

    def twice(sorted_: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(sorted_, k)["h"] == x["h"], F.lit(False))

        return F.filter(sorted_, lambda x, k: same(x, k - 1) | same(x, k + 1))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    found = let(F.sort_array(windows), lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
    return F.coalesce(let(found, covered), F.lit(0)).cast("bigint")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))))


def text_keys(text: Column) -> dict[str, Column]:
    """Two fingerprints that tell texts apart, 128 bits together."""
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit("text"), text)}


def host_of(host: Column) -> Column:
    return F.coalesce(host.cast("string"), F.lit(""))


def numbered_lines(docs: DataFrame, text: Column, host: Column) -> DataFrame:
    """Host, 128-bit key of the text, place, hash and words of each line that holds a word."""
    line = F.col("line")
    rows = docs.select(host.alias("host"), *[k.alias(n) for n, k in text_keys(text).items()], F.posexplode(F.split(text, "\n", -1)).alias("place", "line"))
    held = rows.filter(line.rlike(WORD))
    return held.select("host", *KEYS, "place", line_hash(line).alias("h"), F.regexp_count(line, F.lit(WORD)).alias("words"))


def shared_lines(docs: DataFrame, id_column: str, text: Column, host: Column, percent: int) -> DataFrame:
    """Hosts and hashes of the lines above their limit. Rows of one id are one document."""
    hashes = F.array_distinct(F.transform(lines_of(text), line_hash))
    # In a struct, so that a null id counts as an id.
    id_ = F.struct(F.col(id_column)).alias("id")
    lines = docs.select(host.alias("host"), id_, F.xxhash64(text).alias("text"), F.explode(hashes).alias("h"))
    counts = (
        lines.groupBy("host", "h")
        .agg(F.count_distinct("id").alias("n"), F.min("text").alias("a"), F.max("text").alias("b"))
        .filter((F.col("n") > LINE_DOCUMENTS) & (F.col("a") != F.col("b")))
    )
    if percent <= 0:
        return counts.select("host", "h")
    hosts = docs.select(host.alias("host")).groupBy("host").agg(F.count("*").alias("documents"))
    return counts.join(hosts, "host").filter(F.col("n") * 100 > F.col("documents") * percent).select("host", "h")


def lines_above(docs: DataFrame, id_column: str, text: Column, host: Column, percent: int) -> DataFrame:
    """For each host and text that has any: words and places of its lines above the limit.

    Lines meet the limit's table by an equality join; copies of a text are one text."""
    shared = write_staged(shared_lines(docs, id_column, text, host, percent), "shared")
    met = numbered_lines(docs, text, host).join(shared, ["host", "h"])
    each = met.groupBy("host", *KEYS, "place").agg(F.max("words").alias("words"))
    return each.groupBy("host", *KEYS).agg(F.sum("words").alias("gone"), F.sort_array(F.collect_list("place")).alias("places"))


def without_lines(text: Column, places: Column) -> Column:
    """text without the lines at places (in order); as it is if places is null."""

    def left(lines: Column, at: Column) -> Column:
        # What stands between one place and the next.
        edges = F.concat(F.array(F.lit(-1)), at, F.array(F.size(lines)))
        between = F.transform(at, lambda x, k: F.slice(lines, F.get(edges, k) + 2, x - F.get(edges, k) - 1))
        last = F.get(edges, F.size(at))
        rest = F.slice(lines, last + 2, F.size(lines) - last - 1)
        return F.array_join(F.concat(F.flatten(between), rest), "\n")

    parts = F.struct(F.split(text, "\n", -1).alias("lines"), places.alias("at"))
    return F.when(places.isNull(), text).otherwise(let(parts, lambda x: left(x["lines"], x["at"])))


def measures(text: Column) -> Column:
    """Base measures, as a struct."""

    def measured(x: Column) -> Column:
        words, lines = x["words"], x["lines"]
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
        )

    # Bound step by step, so that no text is split twice however the result is used.
    parts = F.struct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), lines_of(text).alias("lines"))
    return let(parts, measured)


def verdict(m: Column, gone: Column) -> Column:
    """The measures with base_failed, kept and the words left without those gone."""
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])
    left = m["n_words"] - F.coalesce(gone, F.lit(0))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return F.struct(
        *[m[n].alias(n) for n in names],
        failed.alias("base_failed"),
        (~failed & (100 * left >= LEAST_LEFT_PERCENT * m["n_words"])).alias("kept"),
        left.alias("words_left"),
    )


def judged(docs: DataFrame, columns: list[str], id_column: str, text_column: str, host_column: str, percent: int) -> tuple[DataFrame, str, str]:
    """Columns of docs with a struct of base measures, base_failed, kept and words left,
    and the places of the lines above their limit; the names of these two."""
    text, host = F.coalesce(F.col(text_column), F.lit("")), host_of(F.col(host_column))
    found = lines_above(docs, id_column, text, host, percent)
    own = {name: unused(docs, name) for name in ("host", *KEYS, "gone", "places", "rules")}
    keys = [own[name] for name in ("host", *KEYS)]
    # Measured before the join, so that a text moves only if columns has it.
    rows = docs.withColumns({own["host"]: host, **{own[n]: k for n, k in text_keys(text).items()}, own["rules"]: measures(text)})
    rows = rows.select(*columns, *keys, own["rules"]).join(found.withColumnsRenamed(own), keys, "left")
    return rows.withColumn(own["rules"], verdict(F.col(own["rules"]), F.col(own["gone"]))), own["rules"], own["places"]


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", line_percent: int = LINE_PERCENT
) -> DataFrame:
    """doc_id, the base measures, base_failed, kept, and the words left."""
    rows, verdicts, _ = judged(docs.select(id_column, text_column, host_column), [id_column], id_column, text_column, host_column, line_percent)
    return rows.select(F.col(id_column).alias("doc_id"), f"{verdicts}.*")


def keep_good(
    docs: DataFrame, text_column: str = "text", host_column: str = "source", line_percent: int = LINE_PERCENT, id_column: str = "doc_id"
) -> DataFrame:
    """Rows of docs that are kept, their text without the lines above the limit; other columns as they are."""
    rows, verdicts, places = judged(docs, docs.columns, id_column, text_column, host_column, line_percent)
    kept = rows.filter(F.col(verdicts)["kept"])
    return kept.withColumn(text_column, without_lines(F.col(text_column), F.col(places))).select(docs.columns)
