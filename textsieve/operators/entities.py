"""Person and location masks from a gazetteer of names, and the table of entities found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsieve.functions.classes import NOT_AFTER_WORD, NOT_BEFORE_WORD, WORD_SET
from textsieve.functions.pii import ENTITIES, changed, cut, cut_patterns, mask_patterns
from textsieve.staging import write_staged


def name_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([{WORD_SET}]+)"), F.lit(1))


# A name is looked up by a run of so many of its words, or by all of them if they are fewer.
RUN = 3


def _runs(df: DataFrame, text: Column, *columns: str) -> DataFrame:
    """(columns, first, run): at each word of a text, the runs of one to RUN words that begin there.

    A run longer than the rest of the text is left out.
    """
    words = df.select(*columns, name_words(text).alias("words"))
    size = F.size("words")
    side_by_side = F.arrays_zip(*(F.slice("words", i + 1, size).alias(f"w{i}") for i in range(RUN)))
    # Zipped lists end in nulls.
    at = words.select(*columns, size.alias("size"), F.explode(side_by_side).alias("at"))
    runs = [
        F.when(F.col(f"at.w{i}").isNotNull(), F.concat_ws(" ", *(F.col(f"at.w{j}") for j in range(i + 1))))
        for i in range(RUN)
    ]
    return at.select(*columns, "size", F.col("at.w0").alias("first"), *(run.alias(f"run{i + 1}") for i, run in enumerate(runs)))


def _keys(names: DataFrame) -> DataFrame:
    """(entity, phrase, first, run): the runs that each name may be filed under."""
    runs = _runs(names, F.col("phrase"), "entity", "phrase")
    longest = F.coalesce(*(F.when(F.col("size") == i, F.col(f"run{i}")) for i in range(1, RUN)), F.col(f"run{RUN}"))
    return runs.select("entity", "phrase", "first", longest.alias("run")).filter(F.col("run").isNotNull()).distinct()


def gazetteer_hits(
    df: DataFrame, gazetteer: DataFrame, id_col: str = "id", text: str = "text", masked: bool = False
) -> DataFrame:
    """(id, names): names is array<struct<entity, phrase>>, the gazetteer names a text may hold.

    A name is filed under its words, or under that run of RUN of its words which the
    fewest texts hold if it has more of them. A text gives out at most RUN runs at
    each of its words, however long the names are, and none where no name's run
    begins. A text that holds a name's run is a candidate, and the name itself is
    looked for in place when it is masked. So the candidates of a text are bounded by
    its length, not by how many names share a frequent word. Texts meet the runs by
    equality, so the gazetteer's size decides between broadcast and shuffle, and no
    text moves. Ids without a candidate are left out.

    With masked, names are looked for in texts whose pattern entities are masked
    first, and a name may stand right beside a mask.
    """
    names = gazetteer.select("entity", "phrase").distinct()
    keys = write_staged(_keys(names), "name-runs")
    firsts = write_staged(keys.select("first").distinct(), "first-words")
    column = F.col(text)
    if masked:
        patterns = mask_patterns(column)
        column = F.when(patterns == column, column).otherwise(F.concat_ws("\n", column, patterns))
    begun = _runs(df, column, id_col).join(firsts, "first", "left_semi")
    runs = F.explode(F.array(*(f"run{i + 1}" for i in range(RUN))))
    given = begun.select(id_col, runs.alias("run")).filter(F.col("run").isNotNull())
    known = keys.select("run").distinct()
    seen = write_staged(given.join(known, "run", "left_semi").distinct(), "runs-of-names")
    texts = seen.groupBy("run").agg(F.count(F.lit(1)).alias("texts"))
    rarest = F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), F.col("run")))
    filed = keys.join(texts, "run", "left").groupBy("entity", "phrase").agg(rarest["run"].alias("run"))
    return seen.join(filed, "run").groupBy(id_col).agg(F.collect_set(F.struct("entity", "phrase")).alias("names"))


def _in_order(names: Column, text: Column) -> Column:
    """The names that the text holds, longest first."""
    held = F.filter(names, lambda name: F.contains(text, name["phrase"]))
    return F.array_sort(
        F.transform(
            held,
            lambda n: F.struct(
                (-F.length(n["phrase"])).alias("longest_first"),
                n["phrase"].alias("phrase"),
                n["entity"].alias("entity"),
            ),
        )
    )


def _whole_word(name: Column) -> Column:
    quoted = F.replace(name["phrase"], F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    # A phrase that is itself the name of a mask must not be found inside one.
    inside = name["phrase"].isin(*ENTITIES)
    before = F.when(inside, F.lit("(?<!<)")).otherwise(F.lit(""))
    return F.concat(before, F.lit(NOT_AFTER_WORD + r"\Q"), quoted, F.lit(r"\E" + NOT_BEFORE_WORD))


def mask_names(text: Column, names: Column) -> Column:
    """Replace whole-word occurrences of the names, longest name first."""

    def replace(masked: Column, name: Column) -> Column:
        return F.regexp_replace(masked, _whole_word(name), F.concat(F.lit("<"), name["entity"], F.lit(">")))

    return F.when(names.isNotNull(), F.aggregate(_in_order(names, text), text, replace)).otherwise(text)


def cut_names(pieces: Column, text: Column, names: Column) -> Column:
    """Cut the names out of a text's untouched pieces, longest name first."""

    def step(done: Column, name: Column) -> Column:
        return cut(done, _whole_word(name), name["entity"], lambda part: F.contains(part, name["phrase"]))

    return F.when(names.isNotNull(), F.aggregate(_in_order(names, text), pieces, step)).otherwise(pieces)


def mask_gazetteer(
    df: DataFrame, gazetteer: DataFrame, id_col: str = "id", text: str = "text"
) -> DataFrame:
    """Mask the gazetteer's names in the text column. Adds named = whether any was masked."""
    hits = gazetteer_hits(df, gazetteer, id_col, text)
    joined = df.join(hits, id_col, "left")
    masked = joined.withColumn("masked", mask_names(F.col(text), F.col("names"))).drop("names")
    return (
        masked.withColumn("named", changed(F.col("masked"), F.col(text)))
        .withColumn(text, F.col("masked"))
        .drop("masked")
    )


def pii_entities(
    df: DataFrame, id_col: str = "id", text: str = "text", gazetteer: DataFrame | None = None
) -> DataFrame:
    """Long table (id, entity, value, start, end), one row per match, with its place in the
    original text (characters from 0, end excluded).

    Matches are those that masking replaces: pattern entities in their order, then
    the gazetteer's names, longest first; none overlaps another. A text is cut into
    pieces once per entity, and a place is the running length of the pieces before
    it: short rows, of texts that hold a match alone, go to a window per text.
    """
    original = F.col(text)
    if gazetteer is None:
        rows, pieces = df, cut_patterns(original)
    else:
        rows = df.join(gazetteer_hits(df, gazetteer, id_col, text, masked=True), id_col, "left")
        pieces = cut_names(cut_patterns(original), original, F.col("names"))
    row = F.monotonically_increasing_id().alias("_row")
    cuts = rows.select(F.col(id_col), row, pieces.alias("_pieces"))
    matched = cuts.filter(F.exists("_pieces", lambda piece: piece["entity"].isNotNull()))
    listed = matched.select(id_col, "_row", F.posexplode("_pieces").alias("_at", "_piece")).select(
        id_col,
        "_row",
        "_at",
        F.length("_piece.text").alias("_length"),
        F.col("_piece.entity").alias("entity"),
        F.when(F.col("_piece.entity").isNotNull(), F.col("_piece.text")).alias("value"),
    )
    so_far = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = listed.withColumn("end", F.sum("_length").over(so_far)).filter(F.col("entity").isNotNull())
    return placed.select(id_col, "entity", "value", (F.col("end") - F.col("_length")).alias("start"), "end")
