"""Human labels: samples, accuracy, risk and coverage, agreement, recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions import exprs as E
from attestor.operators.gate import thresholds
from attestor.operators.ranges import running
from attestor.operators.verify import last_by


def stratum_sizes(rows: DataFrame, n: int, by: str | None) -> DataFrame:
    """(by, size, share): rows to draw from each stratum, in proportion, at least one."""
    keys = [F.coalesce(F.col(by), F.lit("")).alias("stratum")] if by else [F.lit("").alias("stratum")]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    total = F.sum("size").over(Window.partitionBy(F.lit(0)))  # one row a stratum
    part = F.least(F.col("size"), F.greatest(F.lit(1), F.bround(n * F.col("size") / total).cast("long")))
    return sizes.select("stratum", "size", F.when(total <= n, F.col("size")).otherwise(part).cast("long").alias("share"))


def draw_order(uid: str, seed: int, purpose: str) -> list[Column]:
    """What samples are drawn in the order of: the SHA-1 of purpose, seed and id, then the id."""
    return [F.sha1(F.concat(F.lit(f"{purpose}:{seed}:"), F.coalesce(F.col(uid).cast("string"), F.lit("")))), F.col(uid)]


def stratified_sample(rows: DataFrame, n: int, by: str | None, uid: str, seed: int = 0) -> DataFrame:
    """At most n rows, in proportion by stratum; which ones depends on the seed and their ids alone.

    Of each stratum the rows of least hash are taken, in two phases: first at most n of each, which Spark cuts in
    every task before the shuffle, then the stratum's share of these.  Rows of equal id count one by one.
    """
    key = F.coalesce(F.col(by), F.lit("")) if by else F.lit("")
    sizes = stratum_sizes(rows, n, by)
    w = Window.partitionBy("stratum").orderBy("_h", uid)
    first = rows.withColumns({"stratum": key, "_h": draw_order(uid, seed, "sample")[0]}).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    chosen = first.join(sizes, "stratum").where(F.col("_n") <= F.col("share"))  # at most n rows a stratum
    return chosen.orderBy(*draw_order(uid, seed, "trim")).limit(n).select(*rows.columns)


def gold_sheet(rows: DataFrame, identity: list[str], shown: list[str]) -> DataFrame:
    """The columns that a reviewer sees, with ``row_uid`` and an empty ``correct``."""
    have = [c for c in (*shown, "trust_score", "review_recommended", "prov_source_url", "prov_page_start") if c in rows.columns]
    return rows.select(E.row_uid(identity).alias("row_uid"), *identity, *[c for c in have if c not in identity], F.lit("").alias("correct"))


def match_gold(gold: DataFrame, predictions: DataFrame, by: str | None = None) -> DataFrame:
    """Labelled gold rows (row_uid, correct as text) with their prediction's score; ``matched`` tells if there is one.

    Of equal prediction uids the last (by record_seq) counts; unreadable labels are left out.
    """
    cols = [F.coalesce(F.col("trust_score").try_cast("double"), F.lit(0.0)).alias("score"), F.lit(True).alias("_found")]
    group = [F.coalesce(F.col(by).cast("string"), F.lit("")).alias("stratum")] if by else []
    pred = last_by(predictions, ["row_uid"], "record_seq").select("row_uid", *cols, *group)
    labels = gold.select("row_uid", E.parse_correct(F.col("correct")).alias("correct")).where("correct is not null")
    joined = labels.join(pred, "row_uid", "left")
    return joined.withColumn("matched", F.coalesce("_found", F.lit(False))).drop("_found")


def accuracy(matched: DataFrame) -> DataFrame:
    """One row: labelled and matched, unmatched, accuracy and its Wilson interval (4 places)."""
    n, k = F.count_if(F.col("matched")), F.count_if(F.col("matched") & F.col("correct"))
    out = matched.agg(n.alias("n_labeled"), F.count_if(~F.col("matched")).alias("n_unmatched_gold"), k.alias("n_correct"))
    low, high = E.wilson(F.col("n_correct"), F.col("n_labeled"))
    return out.withColumns(
        {
            "overall_accuracy": F.when(F.col("n_labeled") > 0, F.round(F.col("n_correct") / F.col("n_labeled"), 4)),
            "ci_low": F.round(low, 4), "ci_high": F.round(high, 4),
        }
    )


def risk_coverage(labelled: DataFrame) -> DataFrame:
    """Accuracy among the rows of highest score, row by row; ties in the order of ``record_seq``, in ranges like all others."""
    out = running(labelled, [-F.col("score"), F.col("record_seq")], {"_i": F.lit(1), "_k": F.col("correct").cast("int")})
    i, k = F.col("_i"), F.col("_k")
    return out.select(
        i.cast("long").alias("rank"), F.round(i / F.col("_i_all"), 3).alias("coverage"), F.round(k / i, 4).alias("accuracy"), F.round("score", 4).alias("trust_threshold")
    )


def evaluate(gold: DataFrame, predictions: DataFrame, alpha: float = 0.05, delta: float = 0.05, by: str | None = None) -> dict[str, DataFrame]:
    """The parts of an evaluation report: accuracy, threshold, coverage, thresholds by stratum, curve."""
    matched = match_gold(gold, predictions, by)
    used = matched.where("matched")
    tau = thresholds(used, alpha, delta)
    kept = used.crossJoin(F.broadcast(tau)).where("score >= threshold")  # one row
    n, bad = F.count(F.lit(1)), F.count_if(~F.col("correct"))
    report = {"accuracy": accuracy(matched), "threshold": tau, "accepted": kept.agg(n.alias("accepted"), F.round(bad / F.nullif(n, F.lit(0)), 4).alias("accepted_error"))}
    if by:
        report["stratified_thresholds"] = thresholds(used, alpha, delta, "stratum")
    return report | {"risk_coverage": risk_coverage(used.withColumn("record_seq", F.col("row_uid")))}


def labels(sheet: DataFrame, order: str = "record_seq") -> DataFrame:
    """(row_uid, correct) of the rows that can be read; of equal uids the last counts."""
    parsed = sheet.select(E.strip(F.col("row_uid")).alias("row_uid"), E.parse_correct(F.col("correct")).alias("correct"), order)
    return last_by(parsed.where("row_uid <> '' and correct is not null"), ["row_uid"], order).select("row_uid", "correct")


def _corrected(observed: Column, chance: Column) -> Column:
    return F.when(chance == 1, F.when(observed == 1, 1.0).otherwise(0.0)).otherwise((observed - chance) / F.nullif(1 - chance, F.lit(0.0)))


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row for two reviewers' shared rows: agreement, Cohen's kappa, Gwet's AC1, the four counts."""
    both = a.select("row_uid", F.col("correct").alias("x")).join(b.select("row_uid", F.col("correct").alias("y")), "row_uid")
    c = lambda cond: F.count_if(cond)
    x, y = F.col("x"), F.col("y")
    t = both.agg(
        F.count(F.lit(1)).alias("n_overlap"), c(x & y).alias("both_correct"), c(~x & ~y).alias("both_incorrect"),
        c(x & ~y).alias("a_correct_b_incorrect"), c(~x & y).alias("a_incorrect_b_correct"),
    )
    n = F.nullif(F.col("n_overlap"), F.lit(0)).cast("double")
    po = (F.col("both_correct") + F.col("both_incorrect")) / n
    pa, pb = (F.col("both_correct") + F.col("a_correct_b_incorrect")) / n, (F.col("both_correct") + F.col("a_incorrect_b_correct")) / n
    pi = (pa + pb) / 2
    return t.withColumns(
        {
            "percent_agreement": F.round(po, 4), "cohen_kappa": F.round(_corrected(po, pa * pb + (1 - pa) * (1 - pb)), 4),
            "gwet_ac1": F.round(_corrected(po, 2 * pi * (1 - pi)), 4),
        }
    )


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row_uid) of shared rows that the reviewers judge differently, in order."""
    both = a.select("row_uid", F.col("correct").alias("x")).join(b.select("row_uid", F.col("correct").alias("y")), "row_uid")
    return both.where("x <> y").select("row_uid").orderBy("row_uid")


def page_recall(reference: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_reference, n_found, recall) by page, from reference rows that say whether they are ``found``."""
    return reference.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reference"), F.count_if("found").alias("n_found")).withColumn("recall", F.col("n_found") / F.col("n_reference"))


def pooled_recall(pages: DataFrame) -> DataFrame:
    """One row: recall of all pages together, and the mean over pages that have references."""
    some = F.col("n_reference") > 0
    return pages.agg(
        F.sum("n_reference").alias("n_reference"), F.sum("n_found").alias("n_found"),
        (F.sum("n_found") / F.nullif(F.sum("n_reference"), F.lit(0))).alias("pooled_recall"), F.avg(F.when(some, F.col("recall"))).alias("mean_page_recall"),
    )


def consensus(trust: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(row_uid, score, correct) of labelled rows: both reviewers must say correct where both judged."""
    x, y = a.select("row_uid", F.col("correct").alias("_x")), b.select("row_uid", F.col("correct").alias("_y"))
    labelled = x.join(y, "row_uid", "full").select("row_uid", (F.coalesce("_x", "_y") & F.coalesce("_y", "_x")).alias("correct"))
    return trust.select("row_uid", "score").join(labelled, "row_uid")


def at_best_score(labelled: DataFrame) -> DataFrame:
    """One row: distinct scores, rows and errors at the highest."""
    scores = labelled.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("correct")).alias("errors"))
    return scores.agg(F.count(F.lit(1)).alias("distinct_scores"), F.max_by("n", "score").alias("n_at_max"), F.max_by("errors", "score").alias("errors_at_max"))


def accuracy_by(labelled: DataFrame, bucket: str) -> DataFrame:
    """(bucket, n, n_correct, accuracy, low, high) with the plain Wilson interval, not rounded or clamped."""
    out = labelled.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("n_correct"))
    p, n, z = F.col("n_correct") / F.col("n"), F.col("n"), 1.96
    centre, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return out.withColumns({"accuracy": p, "low": centre - half, "high": centre + half})


def human_recall(pages: DataFrame) -> DataFrame:
    """One row: records present over present and missed, as people counted them page by page."""
    present, missed = F.sum("present"), F.sum("missed")
    return pages.agg(present.alias("present"), missed.alias("missed"), (present / F.nullif(present + missed, F.lit(0))).alias("recall"))


def double_scored(sample: DataFrame, n: int, uid: str, seed: int = 0) -> DataFrame:
    """Add ``double_scored``: the n rows (all, where there are fewer) that both reviewers get.

    They are the first in an order that the seed and the ids give, whatever the sample's own, so those of a
    smaller n are among those of a larger one.  The window passes the sample alone, which its drawing has bounded.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(*draw_order(uid, seed, "double"))
    return sample.withColumn("double_scored", F.row_number().over(w) <= n)


def misses(found: DataFrame, keys: list[str], most: int = 5) -> DataFrame:
    """At most ``most`` names of each page that weren't found, in order."""
    w = Window.partitionBy(*keys).orderBy("name")
    return found.where("not found").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def pick_pages(pages: DataFrame, key: str, page: str, per_document: int = 3, total: int | None = None, seed: int = 0) -> DataFrame:
    """A sample of pages for recall studies: a few of each document, by the hash of their ids."""
    h = F.xxhash64(F.lit(seed), key, page)
    chosen = pages.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(h, page))).where(F.col("_n") <= per_document).drop("_n")
    return chosen.orderBy(h, key, page).limit(total) if total else chosen
