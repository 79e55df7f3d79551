"""Mixing sources to target weights with a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowengine.llm.common import SPACE_CLASS, materialised, running

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words that the mix takes for each word there is, and how often it may take one.
SHARE, MOST = 1.5, 2
#: Words in a block.
BLOCK_WORDS = 1024
#: Seed of the shuffle.
SEED = "mix"

#: 2^32 less its golden section: successive multiples, modulo 2^32, spread evenly at any length.
_STEP, _POINTS = 1_640_531_527, 1 << 32
#: Cells in which points meet their source's stretch.
_CELLS = 1 << 12
#: Slots whose ranks are counted together, hexadecimal digits that cut a source's shuffle.
_STRETCH, _DIGITS = 1 << 16, 3

_ROW = ["doc_id", "text_key", "lang", "source", "n_chars"]


def words(text: Column) -> Column:
    """The number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, no, source_size, target, quota): how many words the mix takes of each source.

    Sources are numbered in code point order, null last. All targets are `SHARE` of all words
    together and in proportion to the weights, but at most `MOST` times their source's size: with
    sources in the order in which they reach that, the level at which the rest share what is left
    is the largest of the levels so far. `quota` is the target in whole words. Sources are
    numbered and summed up by ranges, so that they may be as many as hosts are.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = [F.col("source").isNull(), F.col("source")]
    weights = F.array(*map(F.lit, WEIGHTS))
    weighted = running(sources, in_order, {}, "mix-sources").withColumn(
        "weight", F.get(weights, (F.col("no") % len(WEIGHTS)).cast("int"))
    )
    filling = weighted.withColumnRenamed("no", "in_order").withColumn(
        "most", F.col("source_size") * MOST
    )
    levelled = materialised(
        running(
            filling, [F.col("source_size") / F.col("weight"), F.col("in_order")],
            {"full": F.col("most"), "filled": F.col("weight")}, "mix-filling",
        ),
        "mix-levels",
    )
    words_of_all, weight_of_all = levelled.agg(F.sum("source_size"), F.sum("weight")).first()
    shared = F.lit(words_of_all or 0) * F.lit(SHARE)
    level = (shared - F.col("full")) / (F.lit(weight_of_all or 1) - F.col("filled"))
    highest = levelled.agg(F.max(level)).first()[0]
    target = F.least(
        F.col("most").cast("double"), F.lit(highest).cast("double") * F.col("weight")
    )
    return levelled.select(
        "source", F.col("in_order").alias("no"), "source_size", target.alias("target"),
        F.floor(target + 0.5).alias("quota"),
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, no, rank): which source, and which of its blocks, fills each slot of the mix.

    Slot i is at the golden-ratio point i on the line of cumulative quotas. A source's slots are
    ranked in order; ranks beyond its quota are void, and the few ranks that the points fall short
    of follow at the end. Points meet sources in cells of the line, so the join has no ranges
    without a key; ranks are counted in stretches of slots, so no group is a whole source.
    """
    spark = sources.sparkSession
    needed = sources.select("no", "quota", F.ceil(F.col("quota") / block_words).alias("blocks"))
    total, all_words = needed.agg(F.sum("blocks"), F.sum("quota")).first()
    placed = running(
        needed.withColumnRenamed("no", "source_no"), ["source_no"], {"low": F.col("quota")},
        "mix-line",
    )

    def point_at(words_before: Column) -> Column:
        wide = words_before.cast("decimal(20,0)") * F.lit(_POINTS).cast("decimal(11,0)")
        return F.floor(wide / F.lit(max(all_words or 0, 1))).cast("long")

    lines = placed.select(
        F.col("source_no").alias("no"), point_at(F.col("low")).alias("low"),
        point_at(F.col("low") + F.col("quota")).alias("high"),
    ).where("high > low")
    width = _POINTS // _CELLS
    cells = lines.select(
        "no", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
        .alias("cell"),
    )
    points = spark.range(total or 0).select(
        F.col("id").alias("slot"), ((F.col("id") % _POINTS) * _STEP % _POINTS).alias("point")
    ).withColumn("cell", F.floor(F.col("point") / width))
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    drawn = points.join(cells, "cell").where(inside).select(
        "slot", "no", F.floor(F.col("slot") / _STRETCH).alias("stretch")
    )
    counted = drawn.groupBy("no", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("no").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counted.select(
        "no", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("no", "stretch").orderBy("slot")
    ranked = (
        drawn.withColumn("place", F.row_number().over(within) - 1)
        .join(bases, ["no", "stretch"])
        .select("slot", "no", (F.col("base") + F.col("place")).alias("rank"))
    )
    used = ranked.join(needed.select("no", "blocks"), "no").where("rank < blocks").drop("blocks")
    drawn_of = counted.groupBy("no").agg(F.sum("n").alias("had"))
    short = needed.join(drawn_of, "no", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    late = short.where("had < blocks").select(
        "no", F.explode(F.sequence(F.col("had"), F.col("blocks") - 1)).alias("rank")
    )
    return used.select("slot", "no", "rank").union(
        late.select((F.lit(total or 0) + F.col("rank")).alias("slot"), "no", "rank")
    )


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows in their source's shuffled order, with the words before them. The shuffle is by a
    digest of the id; its first digits cut a source into parts that are summed up first."""
    mark = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                        F.lit("null"))).cast("binary"))
    rows = sized.withColumn("mark", mark).withColumn("part", F.substring("mark", 1, _DIGITS))
    keyed = rows.join(sources.withColumnRenamed("source", "its_source"),
                      F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    sums = keyed.groupBy("no", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("no", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0))
                        .alias("base"))
    before = (
        Window.partitionBy("no", "part").orderBy("mark", "size", "doc_id", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("size").over(before), F.lit(0))
    return keyed.withColumn("inside", inside).join(bases, ["no", "part"]).select(
        *_ROW, "size", "no", "source_size", "target", "quota",
        (F.col("base") + F.col("inside")).alias("start"),
    )


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix's pieces and every document's share in it: the golden-ratio schedule says which
    block of which source is where, and so which document.

    The first frame has (slot, doc_id, text_key, lang, source, n_chars, size, no, start, epoch,
    first_word, last_word): in slot order, the words of a document that a block takes. Each
    source's shuffled documents, repeated without end, are cut into blocks of equal numbers of
    words; the source's slot of rank r takes block r, and the last one ends at the quota. The
    second has one row for each input row: (doc_id, text_key, lang, source, n_chars, size,
    source_size, target, taken, first_slot, n_slots), with the slot at which it is taken first,
    null if it is not, and the number of slots that take words of it.

    Sizes and targets are as in `words` and `targets`. A source's taken words are its target
    rounded to a whole word, and no document gives more than twice its size. The shuffle depends
    on ids alone, so reruns agree; rows with the same id are next to each other, the shorter
    first. Null and empty texts have size 0 and give nothing; a null source is a source. Extra
    columns are left out, whatever their names. An empty table gives no rows.
    """
    sized = materialised(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
            "lang", "source", F.col("n_chars").cast("long").alias("n_chars"),
            words(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    sources = materialised(targets(sized), "mix-targets")
    placed = materialised(_placed(sized, sources), "mix-places")
    # the repeated documents as stretches of the source's endless line, up to the quota
    epochs = F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))).alias("epoch")
    line = (
        placed.where("size > 0").select(*_ROW, "size", "no", "start", "quota", "source_size",
                                        epochs)
        .withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("quota")))
        .where(F.col("from") < F.col("to"))
    )
    blocks = F.sequence(
        F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words)
    )
    in_blocks = line.withColumn("rank", F.explode(blocks))
    low = F.greatest(F.col("from"), F.col("rank") * block_words)
    high = F.least(F.col("to"), (F.col("rank") + 1) * block_words)
    pieces = in_blocks.join(schedule(sources, block_words), ["no", "rank"]).select(
        "slot", *_ROW, "size", "no", "start", "epoch",
        (low - F.col("from")).alias("first_word"),
        (high - F.col("from")).alias("last_word"),
    )
    length = F.col("last_word") - F.col("first_word")
    taken = pieces.groupBy("no", "start").agg(
        F.sum(length).alias("taken"), F.min("slot").alias("first_slot"),
        F.count("*").alias("n_slots"),
    )
    places = placed.alias("placed")
    gave = taken.withColumnRenamed("no", "its_no").withColumnRenamed("start", "its_start")
    same = (
        (F.col("size") > 0) & (F.col("no") == F.col("its_no"))
        & (F.col("start") == F.col("its_start"))
    )
    shares = places.join(gave, same, "left").select(
        *_ROW, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        "first_slot", F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
    )
    return pieces, shares


def mixed_documents(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text, lang, source, n_chars): the mix as documents, in the order of the schedule.

    A document is there once for each time that the mix takes it whole, at the first slot that
    takes words of it then; the one at which a source's quota ends is cut after its last taken
    word, with single blanks between words. Documents that the mix takes nothing of are not there.
    Partitions are ranges of slots, and written one after the other they are the schedule.
    """
    pieces, _ = mix(documents, block_words)
    length = F.col("last_word") - F.col("first_word")
    copies = pieces.groupBy("no", "start", "epoch", *_ROW, "size").agg(
        F.sum(length).alias("words"), F.min("slot").alias("slot")
    ).select(_row_key().alias("row_key"), "text_key", "words", "size", "slot", "no", "start")
    # equal rows are one text here; every copy joins it, on the key that it was grouped by
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
           "lang", "source", F.col("n_chars").cast("long").alias("n_chars")]
    texts = documents.select(*key, "text").withColumn("row_key", _row_key()).groupBy(
        "row_key", "text_key"
    ).agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "lang", "source")])
    split = F.split(F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), f"[{SPACE_CLASS}]+")
    cut = F.array_join(F.slice(split, F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text"))
    order = ["slot", "no", "start"]
    return (
        texts.join(copies, ["row_key", "text_key"])
        .select("doc_id", text.alias("text"), "lang", "source", *order)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    )


def _row_key() -> Column:
    """A hash of a row's other columns, with nulls apart from all values."""
    columns = [c for c in _ROW if c != "text_key"]
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
