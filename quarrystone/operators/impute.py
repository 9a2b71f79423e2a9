"""Filling gaps, judging fills, and the masked benchmark."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators import counted
from quarrystone.operators.clean import complete_cases, is_numeric, round_columns, with_stats
from quarrystone.operators.split import Hidden, apply_mask


def missing_count(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(sum((F.count_if(F.col(c).isNull()) for c in columns[1:]), F.count_if(F.col(columns[0]).isNull())).alias("n_missing"))


def missing_fraction(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))
    return one.unpivot([], columns, "column", "fraction").filter("fraction > 0").orderBy(F.desc("fraction"), "column")


def mean_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Observed means in the gaps of numeric columns."""
    stats = df.agg(*(F.avg(c).alias(f"_m_{c}") for c in columns))
    return with_stats(df, stats).select(*(F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column <its place> the most frequent value, the smallest of them; null where there is none.

    All columns of a type are counted in one grouping of (column, value), so the plan doesn't grow with them.
    """
    parts = []
    for kind in dict.fromkeys(df.schema[c].dataType for c in columns):
        own = [(i, c) for i, c in enumerate(columns) if df.schema[c].dataType == kind]
        long = df.select(*(F.col(c).alias(f"_{i}") for i, c in own)).unpivot([], [f"_{i}" for i, _ in own], "column", "value")
        counts = long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
        here = lambda i, x: F.when(F.col("column") == f"_{i}", x)
        parts.append(counts.agg(*(F.min_by(here(i, F.col("value")), here(i, F.struct(-F.col("n"), F.col("value")))).alias(f"_t_{i}") for i, _ in own)))
    return reduce(DataFrame.crossJoin, parts)  # one row each


def mode_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """The most frequent value, the smallest of them, in the gaps of categorical columns."""
    if not columns:
        return df
    place = {c: i for i, c in enumerate(columns)}
    return with_stats(df, modes(df, columns)).select(*(F.coalesce(F.col(c), F.col(f"_t_{place[c]}")).alias(c) if c in place else F.col(c) for c in df.columns))


def constant_shortcut(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with one observed value are filled with it; others, and all-missing ones, stay."""
    stats = df.agg(*(F.when(F.min(c) == F.max(c), F.min(c)).alias(f"_o_{c}") for c in columns))
    return with_stats(df, stats).select(*(F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns))


def clamp_observed(original: DataFrame, filled: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Observed cells as they were, the fill elsewhere."""
    f = filled.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_f_{c}") for c in columns))
    return original.join(f, F.col(key) == F.col("_k"), "left").select(*(F.coalesce(F.col(c), F.col(f"_f_{c}")).alias(c) if c in columns else F.col(c) for c in original.columns))


def average_draws(draws: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return draws.groupBy(key).agg(*(F.avg(c).alias(c) for c in columns))


def model_fill(df: DataFrame, key: str, columns: list[str], context: list[str], checkpoint=checkpointed, start: DataFrame | None = None) -> DataFrame:
    """One pass: each column with gaps is predicted from the current values of all others.

    Numbers and categories by boosted trees, fitted on observed rows. ``context`` may hold more columns than
    are filled. ``checkpoint``, a function of a DataFrame, cuts the lineage of what models are fitted on after
    each column. ``start`` (the same rows without gaps) gives the values to begin with instead of means and modes.
    """
    if start is None:
        every = dict.fromkeys([*context, *columns])
        current = mode_fill(mean_fill(_marked(df, columns), [c for c in every if is_numeric(df, c)]), [c for c in every if not is_numeric(df, c)])
    else:
        flags = _marked(df, columns).select(F.col(key).alias("_k"), *(f"_g_{c}" for c in columns))
        current = start.select(*df.columns).join(flags, F.col(key) == F.col("_k")).drop("_k")
    return _refilled(current, columns, context, checkpoint).select(*df.columns)


def _marked(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with _g_<column>, whether the cell is a gap."""
    return df.withColumns({f"_g_{c}": F.col(c).isNull() for c in columns})


#: Models whose fills are put into the rows before their lineage is cut.
CUT_EVERY = 8


def _refilled(current: DataFrame, columns: list[str], context: list[str], checkpoint, passes: int = 1) -> DataFrame:
    """``model_fill``, ``passes`` times, of a frame without gaps that says by _g_<column> where they were; no join, as the flags go with the rows.

    Rows are counted by what models see of them and by where their gaps were (``counted``), in one pass; models are fitted
    on these counts, whose fills follow along, and put into the rows in the end, which are neither shuffled nor kept. A
    column without gaps needs no model, one without an observed cell stays as it is, and one with a single value is filled with it.
    """
    every = list(dict.fromkeys([*context, *columns]))
    text = [c for c in every if not is_numeric(current, c)]
    numbers = [c for c in every if c not in text]
    code, gap = (lambda c: f"_b_{c}"), (lambda c: F.col(f"_g_{c}"))
    names, work, attributes, labels = current.columns, current, {}, {}
    if text:
        index = StringIndexer(inputCols=text, outputCols=[code(c) for c in text], stringOrderType="alphabetAsc", handleInvalid="keep").fit(current)
        work, labels = index.transform(work), dict(zip(text, index.labelsArray))
        attributes = {code(c): work.schema[code(c)].metadata for c in text}
    seen = [F.when(~gap(c), F.col(c)).alias(c) if c in columns else F.col(c) for c in numbers]
    cuts = counted.cut_points(current.select(*seen), numbers)
    for c in numbers:
        work = counted.interval(work, c, code(c), cuts[c])
    sums = [F.sum(F.when(~gap(c), F.col(c).cast("double"))).alias(f"_s_{c}") for c in columns if c in numbers]
    cells = checkpoint(work.groupBy(*map(code, every), *(f"_g_{c}" for c in columns)).agg(F.count("*").alias("n"), *sums))
    kinds = [F.struct(F.sum(F.when(gap(c), F.col("n"))).alias("gaps"), F.min(F.when(~gap(c), F.col(code(c)))).alias("low"), F.max(F.when(~gap(c), F.col(code(c)))).alias("high")).alias(f"{i}") for i, c in enumerate(columns)]
    kinds = dict(zip(columns, cells.agg(*kinds).first()))

    def filled(df, c, model):
        """df with the model's fills in the code of a column, and in the column where df has it."""
        inputs, told = [code(x) for x in every if x != c], df.columns
        df = df.withColumn("_p", F.lit(model)) if isinstance(model, float) else model.transform(counted.assembled(df, inputs, attributes))
        if c in text:
            value, new = F.get(F.array(*map(F.lit, labels[c])), F.col("_p").cast("int")), F.col("_p")
        else:
            value, new, df = F.col("_p"), F.col("_q"), counted.interval(df, "_p", "_q", cuts[c])
        own = {c: F.when(gap(c), value).otherwise(F.col(c))} if c in told else {}
        return df.withColumns({code(c): F.when(gap(c), new).otherwise(F.col(code(c)))} | own).select(*told)

    done = 0
    for c in [c for _ in range(passes) for c in columns]:
        kind = kinds[c]
        if not kind["gaps"] or kind["low"] is None:
            continue
        inputs, known = [code(x) for x in every if x != c], cells.filter(~gap(c))
        if c not in text:
            model = counted.fit(known.groupBy(*inputs).agg((F.sum(f"_s_{c}") / F.sum("n")).alias("_y"), F.sum("n").alias("n")), inputs, attributes, None)
        elif kind["low"] == kind["high"]:
            model = kind["low"]
        else:
            model = counted.fit(known.groupBy(*inputs, F.col(code(c)).alias("_y")).agg(F.sum("n").alias("n")), inputs, attributes, len(labels[c]))
        cells, work, done = checkpoint(filled(cells, c, model)), filled(work, c, model), done + 1
        if done % CUT_EVERY == 0:
            work = checkpoint(work)
    return work.select(*names)


def impute(df: DataFrame, key: str, numeric: list[str], categorical: list[str], method: str = "mean", passes: int = 1, refine: list[str] | None = None, checkpoint=checkpointed, marked: bool = False) -> DataFrame:
    """Fill all gaps; observed cells never change, other columns pass through.

    method 'mean' (means and modes), 'model' (model_fill, ``passes`` times, each from what the one
    before filled), 'drop' (complete cases). ``refine`` limits the model to some columns; the rest
    get means and modes and serve as context. ``marked`` adds _g_<column>, whether the cell was a gap,
    which lets ``polish`` go on without joins.
    """
    if method == "drop":
        return complete_cases(df)
    columns = refine or [*numeric, *categorical]
    flagged = [*numeric, *categorical] if marked else columns if method == "model" else []
    filled = mode_fill(mean_fill(_marked(df, flagged) if flagged else df, numeric), categorical)
    if method == "model":
        filled = _refilled(filled, columns, [*numeric, *categorical], checkpoint, passes)
    return filled.select(*df.columns, *(f"_g_{c}" for c in flagged if marked))


def polish(df: DataFrame, filled: DataFrame, key: str, numeric: list[str], categorical: list[str], columns: list[str] | None = None, checkpoint=checkpointed) -> DataFrame:
    """One more pass of the models over a filled frame; observed cells stay. A frame that ``impute`` marked isn't joined to df."""
    every = [*numeric, *categorical]
    if all(f"_g_{c}" in filled.columns for c in every):
        return _refilled(filled, columns or every, every, checkpoint).select(*df.columns)
    done = model_fill(df, key, columns or every, every, checkpoint, filled)
    return clamp_observed(df, done, key, every)


def run_imputation(df: DataFrame, split: DataFrame, key: str, numeric: list[str], categorical: list[str], rules: dict[str, int], **how) -> DataFrame:
    """Impute, round, and bring the split back."""
    done = round_columns(impute(df, key, numeric, categorical, **how), rules, numeric)
    return done.join(split.select(key, "split"), key)


def validate_imputed(original: DataFrame, imputed: DataFrame, key: str, numeric: list[str], categorical: list[str], margin: float = 0.2) -> DataFrame:
    """(column, n_imputed, n_valid, all_valid): fills within the observed range and a margin, or among observed values.

    Numeric columns are counted in one aggregate; filled categories, counted by value, are looked
    up among the observed values of their column by an ordinary join.
    """
    gaps = original.select(F.col(key).alias("_k"), *(F.col(c).isNull().alias(f"_g_{c}") for c in [*numeric, *categorical]))
    both = imputed.join(gaps, F.col(key) == F.col("_k"))
    parts = []
    if numeric:
        s = original.agg(*(x for c in numeric for x in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))))
        room = lambda c: margin * (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
        ok = lambda c: F.col(f"_g_{c}") & F.col(c).between(F.col(f"_lo_{c}") - room(c), F.col(f"_hi_{c}") + room(c))
        one = both.crossJoin(F.broadcast(s)).agg(*(F.struct(F.count_if(f"_g_{c}").alias("n_imputed"), F.count_if(ok(c)).alias("n_valid")).alias(c) for c in numeric))
        parts.append(one.unpivot([], numeric, "column", "s").select("column", "s.*"))
    if categorical:
        cells = lambda df, test: df.select(F.explode(F.filter(F.array(*(F.when(test(c), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c in categorical)), lambda x: x.isNotNull())).alias("_x")).select("_x.*")
        filled = cells(both, lambda c: F.col(f"_g_{c}")).groupBy("column", "value").agg(F.count("*").alias("n"))
        seen = cells(original, lambda c: F.col(c).isNotNull()).distinct().withColumn("_ok", F.lit(True))
        counts = filled.join(seen, ["column", "value"], "left").groupBy("column").agg(F.sum("n").alias("n_imputed"), F.coalesce(F.sum(F.when(F.col("_ok"), F.col("n"))), F.lit(0)).alias("n_valid"))
        names = original.sparkSession.createDataFrame([(c,) for c in categorical], "column string")
        parts.append(names.join(counts, "column", "left").fillna(0, ["n_imputed", "n_valid"]))
    return reduce(DataFrame.unionByName, parts).withColumn("all_valid", F.col("n_imputed") == F.col("n_valid"))


def validation_report(original: DataFrame, imputed: DataFrame, key: str, numeric: list[str], categorical: list[str], margin: float = 0.2) -> DataFrame:
    """For each column with gaps: observed and imputed mean and sample deviation (numeric columns), and the checks."""
    checks = validate_imputed(original, imputed, key, numeric, categorical, margin).filter("n_imputed > 0")
    was = original.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_o_{c}") for c in numeric))
    both = imputed.select(key, *numeric).join(was, F.col(key) == F.col("_k"))
    new = lambda c: F.when(F.col(f"_o_{c}").isNull(), F.col(c))
    stats = lambda c: F.struct(F.avg(f"_o_{c}").alias("obs_mean"), F.stddev_samp(f"_o_{c}").alias("obs_std"), F.avg(new(c)).alias("imp_mean"), F.stddev_samp(new(c)).alias("imp_std")).alias(c)
    one = both.agg(*(stats(c) for c in numeric)).unpivot([], numeric, "column", "s").select("column", "s.*")
    return checks.join(one, "column", "left")


def validation_pass_rate(report: DataFrame) -> DataFrame:
    return report.select("column", F.coalesce(F.col("n_valid") / F.nullif(F.col("n_imputed"), F.lit(0)), F.lit(1.0)).alias("pass_rate"))


def masked_rows(truth: DataFrame, imputed: DataFrame, mask: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row for each key: for each column its truth _t_, its fill _p_ and whether the cell was masked _m_."""
    flags = mask.groupBy(F.col(key).alias("_k")).agg(*(F.bool_or(F.col("column") == c).alias(f"_m_{c}") for c in columns))
    a = truth.select(key, *(F.col(c).alias(f"_t_{c}") for c in columns))
    b = imputed.select(F.col(key).alias("_i"), *(F.col(c).alias(f"_p_{c}") for c in columns))
    rows = a.join(b, F.col(key) == F.col("_i")).join(flags, F.col(key) == F.col("_k"), "left").drop("_i", "_k")
    return rows.withColumns({f"_m_{c}": F.coalesce(f"_m_{c}", F.lit(False)) for c in columns})


def score_numeric(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_masked, mae, rmse) of ``masked_rows``, in population deviations of the unmasked observed cells; one aggregate for all columns."""
    def score(c):
        t, p, m = F.col(f"_t_{c}").cast("double"), F.col(f"_p_{c}").cast("double"), F.col(f"_m_{c}")
        sd, err = F.stddev_pop(F.when(~m, t)), F.when(m, p - t)
        scale = F.when(sd > 0, sd).when(F.count(F.when(~m, t)) > 0, 1.0)
        return F.struct(F.count_if(m).alias("n_masked"), (F.avg(F.abs(err)) / scale).alias("mae"), (F.sqrt(F.avg(err * err)) / scale).alias("rmse")).alias(c)

    return rows.agg(*map(score, columns)).unpivot([], columns, "column", "s").select("column", "s.*").filter("n_masked > 0")


def score_categorical(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_masked, accuracy, balanced_accuracy, macro_f1) of ``masked_rows``, from confusion counts of masked cells."""
    cells = F.array(*(F.when(F.col(f"_m_{c}"), F.struct(F.lit(c).alias("column"), F.col(f"_t_{c}").cast("string").alias("truth"), F.col(f"_p_{c}").cast("string").alias("predicted"))) for c in columns))
    pairs = rows.select(F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("_x")).select("_x.*").groupBy("column", "truth", "predicted").agg(F.count("*").alias("n"))
    by_truth = pairs.groupBy("column", F.col("truth").alias("label")).agg(F.sum("n").alias("t"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = pairs.groupBy("column", F.col("predicted").alias("label")).agg(F.sum("n").alias("p"))
    labels = by_truth.join(by_pred, ["column", "label"], "full_outer").fillna(0, ["t", "hit", "p"])
    return labels.groupBy("column").agg(
        F.sum("t").alias("n_masked"), (F.sum("hit") / F.sum("t")).alias("accuracy"),
        F.avg(F.when(F.col("t") > 0, F.col("hit") / F.col("t"))).alias("balanced_accuracy"), F.avg(2 * F.col("hit") / (F.col("t") + F.col("p"))).alias("macro_f1"),
    )


def score_masked(truth: DataFrame, imputed: DataFrame, mask: DataFrame, key: str, numeric: list[str], categorical: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per-column metrics (column, metric, value), and the summary with the objective."""
    return _scores(checkpointed(masked_rows(truth, imputed, mask, key, [*numeric, *categorical])), numeric, categorical)


def _scores(rows: DataFrame, numeric: list[str], categorical: list[str]) -> tuple[DataFrame, DataFrame]:
    """``score_masked`` of ``masked_rows``."""
    parts = []
    if numeric:
        parts.append(score_numeric(rows, numeric).unpivot("column", ["mae", "rmse"], "metric", "value"))
    if categorical:
        parts.append(score_categorical(rows, categorical).unpivot("column", ["accuracy", "balanced_accuracy", "macro_f1"], "metric", "value"))
    long = reduce(DataFrame.unionByName, parts)
    macro = lambda m: F.avg(F.when(F.col("metric") == m, F.col("value")))
    summary = long.agg(*(macro(m).alias(f"macro_{m}") for m in ("mae", "rmse", "accuracy", "balanced_accuracy", "macro_f1")))
    both = F.filter(F.array(F.col("macro_rmse"), 1 - F.col("macro_balanced_accuracy")), lambda x: x.isNotNull())
    return long, summary.withColumn("objective", F.when(F.size(both) > 0, F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / F.size(both)))


def benchmark_objective(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("candidate").agg(F.avg("objective").alias("objective"), F.count("*").alias("n_masks"))


def masked_benchmark(df: DataFrame, key: str, numeric: list[str], categorical: list[str], masks: DataFrame | Hidden, candidates: dict, done: set[tuple] = frozenset()) -> DataFrame:
    """(candidate, mechanism, mask_index, objective): hide, impute and score for every pair not done yet.

    ``candidates``: name -> function of the masked frame. The grid (a handful of rows) drives one
    job for each pair; results are small. Masks are made once for all pairs and candidates. With masks as bits of the
    rows (``split.hidden_grid`` of df), truth and bits go through a fill that keeps other columns, and nothing is joined; rows are kept once.
    """
    columns, parts = [*numeric, *categorical], []
    if isinstance(masks, Hidden):
        grid = sorted({x[:2] for x in masks.names})
        frame = checkpointed(masks.rows.select(key, *columns, "_hidden"))
    else:
        masks = checkpointed(masks)
        grid = [tuple(r) for r in masks.select("mechanism", "mask_index").distinct().orderBy("mechanism", "mask_index").collect()]
        frame = df.select(key, *columns)
    for name, fill in candidates.items():
        for mechanism, i in grid:
            if (name, mechanism, i) in done:
                continue
            if isinstance(masks, Hidden):
                hidden = {c: masks.bit(mechanism, i, c) for c in columns}
                kept = {f"_true_{c}": F.col(c) for c in columns} | {f"_hides_{c}": hidden[c] for c in columns}
                filled = fill(frame.select(key, *(F.when(~hidden[c], F.col(c)).alias(c) for c in columns), *(x.alias(n) for n, x in kept.items())))
                if missing := set(kept) - set(filled.columns):
                    raise ValueError(f"the fill {name!r} drops columns: {sorted(missing)}")
                scored = [x for c in columns for x in (F.col(f"_true_{c}").alias(f"_t_{c}"), F.col(c).alias(f"_p_{c}"), F.col(f"_hides_{c}").alias(f"_m_{c}"))]
                _, summary = _scores(filled.select(*scored), numeric, categorical)
            else:
                mask = masks.filter((F.col("mechanism") == mechanism) & (F.col("mask_index") == i))
                _, summary = score_masked(frame, fill(apply_mask(frame, mask, key)), mask, key, numeric, categorical)
            parts.append(summary.select(F.lit(name).alias("candidate"), F.lit(mechanism).alias("mechanism"), F.lit(i).alias("mask_index"), "objective"))
    return reduce(DataFrame.unionByName, parts)
