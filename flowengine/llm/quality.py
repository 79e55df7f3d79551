"""Quality classifier: text evidence over site priors that are shrunk level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import SPACE_CLASS, materialised

#: Cells that a text's features are hashed into, three hexadecimal digits.
CELLS = 1 << 12
#: Bounds of a level's prior weight, in labels.
WEAKEST, STRONGEST = 1.0, 1e6
#: A document is kept from this probability of good quality on.
KEPT = 0.5
#: Shares of the added-up evidence that are tried: features of one text are not independent.
SHARES = tuple(k / 20 for k in range(1, 21))

# letters and figures by kind; everything else stands for itself
_KINDS = (("[a-zß-öø-ÿ]+", "a"), ("[A-ZÀ-ÖØ-Þ]+", "A"), ("[0-9]+", "0"))
_SITE = ["host", "path"]


def features(text: Column) -> Column:
    """The text's features, each once, as cell numbers in ascending order: the shape of every word
    (which kinds of characters it has in which order), and three figures of the whole text, its
    characters per word, how many of its words are different ones, and the logarithm of their
    number. A feature's cell are the first digits of its MD5."""
    whole = F.coalesce(text, F.lit(""))
    shaped = whole
    for letters, kind in _KINDS:
        shaped = F.regexp_replace(shaped, letters, kind)

    def split(line: Column) -> Column:
        return F.split(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), f"[{SPACE_CLASS}]+")

    words = split(whole)
    n = F.size(words)
    # figures hold a blank, which no word does
    figures = F.array(
        F.concat(F.lit("length "), F.least(F.floor(F.length(whole) / n), F.lit(15)).cast("string")),
        F.concat(F.lit("variety "), F.floor(F.size(F.array_distinct(words)) * 16 / n).cast("string")),
        F.concat(F.lit("words "), F.floor(F.log2(n)).cast("string")),
    )
    names = F.concat(F.array_distinct(split(shaped)), figures)
    cells = F.transform(
        names, lambda name: F.conv(F.substring(F.md5(name.cast("binary")), 1, 3), 16, 10).cast("int")
    )
    return F.array_sort(F.array_distinct(cells))


def _weight(good: Column, deviations: Column, groups: Column, rows: Column) -> Column:
    """How many labels a level's prior is worth: by the method of moments from how much more its
    groups differ than chance explains. `deviations` is the sum of squared differences from the
    prior, weighted by labels."""
    chance = good * (1 - good)
    between = (deviations / F.greatest(groups - 1, F.lit(1)) - chance) * groups / rows
    weight = F.when(between > 0, chance / between - 1).otherwise(STRONGEST)
    return F.least(F.greatest(weight, F.lit(WEAKEST)), F.lit(STRONGEST))


def site_counts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels by site, and what a level's prior weighs.

    `labelled` has host, path, good and bad, the numbers of labels of either kind. The first
    frame has (host, path, path_n, path_k, host_n, host_k) for every labelled path, all and good
    labels; the second one row (all_n, all_k, host_weight, path_weight).
    """
    paths = labelled.groupBy(*_SITE).agg(
        F.sum(F.col("good") + F.col("bad")).alias("path_n"), F.sum("good").alias("path_k")
    )
    hosts = paths.groupBy(F.col("host").alias("its_host")).agg(
        F.sum("path_n").alias("host_n"), F.sum("path_k").alias("host_k")
    )
    sites = materialised(
        paths.join(hosts, F.col("host").eqNullSafe(F.col("its_host"))).drop("its_host"),
        "quality-sites",
    )
    of_hosts = sites.groupBy("host").agg(
        F.max("host_n").alias("host_n"), F.max("host_k").alias("host_k")
    )
    everything = of_hosts.agg(
        F.coalesce(F.sum("host_n"), F.lit(0)).alias("all_n"),
        F.coalesce(F.sum("host_k"), F.lit(0)).alias("all_k"),
    )
    all_n, all_k = everything.first()
    good = F.lit((all_k + 1) / (all_n + 2))
    apart = F.sum(F.col("host_n") * F.pow(F.col("host_k") / F.col("host_n") - good, 2))
    host_weight = of_hosts.agg(
        F.coalesce(_weight(good, apart, F.count("*"), F.sum("host_n")), F.lit(STRONGEST))
    ).first()[0]
    prior = _shrunk(F.col("host_k"), F.col("host_n"), F.lit(host_weight), good)
    apart = F.sum(F.col("path_n") * F.pow(F.col("path_k") / F.col("path_n") - prior, 2))
    path_weight = sites.agg(
        F.coalesce(_weight(good, apart, F.count("*"), F.sum("path_n")), F.lit(STRONGEST))
    )
    weights = everything.select(
        "all_n", "all_k", F.lit(host_weight).alias("host_weight"),
        path_weight.scalar().alias("path_weight"),
    )
    return sites, materialised(weights, "quality-weights")


def _shrunk(good: Column, n: Column, weight: Column, prior: Column) -> Column:
    return (good + weight * prior) / (n + weight)


def fitted(labelled: DataFrame) -> DataFrame:
    """One row (goods, bads, of_good, of_bad): the numbers of labels, and for each cell those of
    texts that have it."""
    cells = labelled.select(F.explode("cells").alias("cell"), "good", "bad").groupBy("cell").agg(
        F.sum("good").alias("g"), F.sum("bad").alias("b")
    )
    grid = labelled.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
    full = grid.join(cells, "cell", "left").select(
        F.struct("cell", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("b", F.lit(0)).alias("b"))
        .alias("row")
    )
    in_order = F.array_sort(F.collect_list("row"))
    totals = labelled.agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("goods"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bads"),
    )
    rows = full.agg(in_order.alias("rows")).scalar()
    return materialised(
        totals.withColumn("rows", rows).select(
            "goods", "bads", F.col("rows.g").alias("of_good"), F.col("rows.b").alias("of_bad")
        ),
        "quality-model",
    )


def _evidence(model: Column) -> Column:
    """The log of how much likelier each of a text's features is in a good text than in a bad one,
    added up. A text's own labels are left out of the counts, and one text is added to each."""
    def ratio(of: str, all_: str, own: str, cell: Column) -> Column:
        return F.log(
            (F.get(model[of], cell) - F.col(own) + 1) / (model[all_] - F.col(own) + 2)
        )

    return F.aggregate(
        "cells", F.lit(0.0),
        lambda sum_, cell: sum_ + ratio("of_good", "goods", "good", cell)
        - ratio("of_bad", "bads", "bad", cell),
    )


def _share(judged: DataFrame) -> DataFrame:
    """One row, one value: the share of the evidence with the least loss on labelled documents, of
    which each is judged without its own labels; the smallest of equal ones, 1 without labels."""
    def loss(share: float) -> Column:
        logit = F.col("base") + F.col("sum") * share
        return F.sum(
            F.col("good") * F.log1p(F.exp(-logit)) + F.col("bad") * F.log1p(F.exp(logit))
        )

    # beyond 700 the exponential is infinite, and so is the loss
    bounded = judged.where(F.col("good") + F.col("bad") > 0).withColumn(
        "sum", F.least(F.greatest("sum", F.lit(-600.0)), F.lit(600.0))
    )
    losses = bounded.agg(F.array(*(F.round(loss(s), 6) for s in SHARES)).alias("losses"))
    best = F.array_position("losses", F.array_min("losses")).cast("int")
    return losses.select(
        F.coalesce(F.get(F.array(*map(F.lit, SHARES)), best - 1), F.lit(1.0)).alias("share")
    )


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, host, path, evidence, prior, quality, kept) of every document.

    `documents` has doc_id, text, host and path, `labels` doc_id and quality (0 or 1). The text's
    evidence is the sum of its features' log likelihood ratios, times the share that fits the
    labelled documents best. The prior is the posterior share of good labels of the document's
    path, shrunk to that of its host and this to that of all; the weights come from how much
    sites differ. Quality is the posterior probability of a good document, and kept says that it
    is at least a half. A labelled document's own labels count neither for its evidence nor for
    its prior. The model is one row; sites have a row for each labelled path.

    A null or empty text is one empty word; null hosts and paths are values. Labels with a null,
    and those of unknown documents, teach nothing; repeated labels count once, and of
    contradicting ones both count. Without labels the evidence is 0 and the prior a half. Every
    input row gives one row, repeated rows and null ids too. Other columns are left out, whatever
    their names.
    """
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("its_id"), F.col("quality").cast("int").alias("good")
        )
        .dropna().distinct().groupBy("its_id")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    )
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "host", "path",
        features(F.col("text")).alias("cells"),
    )
    marked = materialised(
        rows.join(known, F.col("doc_id") == F.col("its_id"), "left").select(
            "doc_id", "host", "path", "cells", F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("bad", F.lit(0)).alias("bad"),
        ),
        "quality-features",
    )
    labelled = marked.where(F.col("good") + F.col("bad") > 0)
    model = fitted(labelled)
    sites, weights = site_counts(labelled)
    of_all = weights.select(F.struct(*weights.columns)).scalar()
    judged = materialised(
        marked.withColumn("model", model.select(F.struct(*model.columns)).scalar())
        .withColumn("all", of_all)
        .select(
            "doc_id", "host", "path", "good", "bad", _evidence(F.col("model")).alias("sum"),
            _odds(_shrunk(
                F.col("all")["all_k"] - F.col("good"),
                F.col("all")["all_n"] - F.col("good") - F.col("bad"), F.lit(2), F.lit(0.5),
            )).alias("base"),
        ),
        "quality-evidence",
    )
    placed = _placed(judged, sites).withColumn("all", of_all)
    own = F.col("good") + F.col("bad")
    everywhere = 1 / (1 + F.exp(-F.col("base")))
    host = _shrunk(
        F.col("host_k") - F.col("good"), F.col("host_n") - own, F.col("all")["host_weight"],
        everywhere,
    )
    path = _shrunk(
        F.col("path_k") - F.col("good"), F.col("path_n") - own, F.col("all")["path_weight"], host
    )
    scored = placed.select(
        "doc_id", "host", "path", path.alias("prior"),
        (F.col("sum") * _share(judged).scalar()).alias("evidence"),
    )
    quality = F.round(1 / (1 + F.exp(-(_odds(F.col("prior")) + F.col("evidence")))), 6)
    return scored.select(
        "doc_id", "host", "path", F.round("evidence", 6).alias("evidence"),
        F.round("prior", 6).alias("prior"), quality.alias("quality"), (quality >= KEPT).alias("kept"),
    )


def _placed(judged: DataFrame, sites: DataFrame) -> DataFrame:
    """Every document with its site's numbers of labels, 0 where there are none."""
    paths = sites.select(
        F.col("host").alias("its_host"), F.col("path").alias("its_path"), "path_n", "path_k"
    )
    hosts = sites.groupBy(F.col("host").alias("that_host")).agg(
        F.max("host_n").alias("host_n"), F.max("host_k").alias("host_k")
    )
    same_path = F.col("host").eqNullSafe(F.col("its_host")) & F.col("path").eqNullSafe(
        F.col("its_path")
    )
    joined = judged.join(paths, same_path, "left").join(
        hosts, F.col("host").eqNullSafe(F.col("that_host")), "left"
    )
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("path_n", "path_k", "host_n", "host_k")}
    )


def _odds(share: Column) -> Column:
    return F.log(share / (1 - share))
