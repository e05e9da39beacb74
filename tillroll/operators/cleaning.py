"""The cleaning job: row sets, step log, decision table and before/after figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import amount_of, holds, is_cancelled, number, records, row_count
from tillroll.functions.ranks import melt, quantiles
from tillroll.operators.prepare import (
    add_amount,
    add_time_parts,
    drop_duplicate_lines,
    flag_cancellations,
    flag_prices,
    flag_quantities,
    positive_quantity_sales,
    valid_price,
)
from tillroll.operators.validate import is_missing, line_groups
from tillroll.schema import BASE_COLUMNS, check_columns


def cleaned_sets(df: DataFrame, copy: str | None = None) -> dict[str, DataFrame]:
    """``flagged`` (distinct lines with flags), ``cleaned`` (price above zero), ``positive_sales``.

    If equal lines are numbered from 0 in the column ``copy``, the first of each is kept, and the column with it.
    """
    check_columns(df)
    distinct = df.filter(F.col(copy) == 0) if copy else drop_duplicate_lines(df)
    flagged = flag_prices(flag_quantities(flag_cancellations(distinct)))
    flagged = add_time_parts(add_amount(flagged), names=False)
    cleaned = valid_price(flagged)
    return {"flagged": flagged, "cleaned": cleaned, "positive_sales": positive_quantity_sales(cleaned)}


def cleaning_facts(df: DataFrame) -> DataFrame:
    """Every count the log and the decision table need, from one grouping of the raw lines."""
    check_columns(df)
    copies, qty, price = F.col("copies"), number(df, "Quantity"), number(df, "UnitPrice")
    priced, sold = holds(price > 0), ~is_cancelled() & holds(qty > 0)

    def raw_rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    return line_groups(df.select(*BASE_COLUMNS)).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"),
        row_count().alias("distinct"),
        F.count_if(priced).alias("cleaned"),
        F.count_if(priced & sold).alias("positive"),
        F.count_if(priced & ~is_cancelled() & ~holds(qty > 0)).alias("kept_sale_without_quantity"),
        raw_rows(price <= 0).alias("raw_bad_price"),
        raw_rows(qty < 0).alias("raw_negative_quantity"),
        raw_rows(is_cancelled()).alias("raw_cancelled"),
        raw_rows(F.col("CustomerID").isNull()).alias("raw_no_customer"),
        raw_rows(F.col("Description").isNull()).alias("raw_no_text"),
    )


def cleaning_log(df: DataFrame) -> DataFrame:
    """Rows before, removed and after each step of the job, with the reason."""
    raw, distinct, cleaned, positive = (F.col(c) for c in ("raw", "distinct", "cleaned", "positive"))
    steps = [
        ("Initial raw dataset", raw, raw, "scan"),
        ("Remove exact duplicates", raw, distinct, "dropped: equal in all base columns"),
        ("Flag cancellation invoices", distinct, distinct, "flagged: IsCancellation"),
        ("Flag negative/zero quantities", distinct, distinct, "flagged: IsNegativeQuantity, IsZeroQuantity"),
        ("Flag zero/negative prices", distinct, distinct, "flagged: IsZeroPrice, IsNegativePrice"),
        ("Remove UnitPrice <= 0", distinct, cleaned, "dropped: UnitPrice is not above 0"),
        ("Add amount and calendar columns", cleaned, cleaned, "added: TotalAmount and parts of InvoiceDate"),
        ("Keep positive sales", cleaned, positive, "dropped: IsCancellation, or Quantity is not above 0"),
    ]
    rows = [
        {
            "step_no": F.lit(i),
            "step": F.lit(name),
            "rows_before": start,
            "rows_removed": start - end,
            "rows_after": end,
            "reason": F.lit(reason),
        }
        for i, (name, start, end, reason) in enumerate(steps)
    ]
    return records(cleaning_facts(df), rows)


def cleaning_decisions(df: DataFrame) -> DataFrame:
    """Seven data issues with their size, what is done about them and what follows from it.

    The last issue shows two counts: all lines left out of positive sales, and in
    ``of_which_not_cancelled`` those among them that are no cancellation.
    """
    f = {c: F.col(c) for c in cleaning_facts(df).columns}
    nothing = F.lit(None).cast("long")
    # treatment: what happens to the lines; reason: the test that finds them; impact: the row sets that lack them
    issues = [
        ("Exact duplicate rows", f["raw"] - f["distinct"], nothing, "dropped", "row_number over the base columns > 1", "full, cleaned, positive_sales"),
        ("UnitPrice <= 0", f["raw_bad_price"], nothing, "flagged, dropped_from cleaned", "IsZeroPrice or IsNegativePrice", "cleaned, positive_sales"),
        ("Negative Quantity", f["raw_negative_quantity"], nothing, "flagged, dropped_from positive_sales", "IsNegativeQuantity", "positive_sales"),
        ("Cancellation invoices", f["raw_cancelled"], nothing, "flagged, dropped_from positive_sales", "IsCancellation", "positive_sales"),
        ("Missing CustomerID", f["raw_no_customer"], nothing, "kept", "CustomerID is null", "customer tables"),
        ("Missing Description", f["raw_no_text"], nothing, "kept", "Description is null", "none"),
        ("Not in positive sales", f["cleaned"] - f["positive"], f["kept_sale_without_quantity"], "dropped_from positive_sales", "IsCancellation or Quantity <= 0", "positive_sales"),
    ]
    rows = [
        {
            "issue": F.lit(issue),
            "count": count,
            "of_which_not_cancelled": part,
            "treatment": F.lit(treatment),
            "reason": F.lit(reason),
            "impact": F.lit(impact),
        }
        for issue, count, part, treatment, reason, impact in issues
    ]
    return records(cleaning_facts(df), rows)


def set_metrics(name: str, df: DataFrame, copy: str | None = None) -> DataFrame:
    """Quality and amount figures of one row set as one row.

    Rows are compared by their base columns: derived columns follow from those. If equal lines are numbered
    from 0 in the column ``copy``, which is no column of the set, duplicates are those with a higher number.
    """
    columns = [c for c in df.columns if c != copy]
    qty, price, amount = number(df, "Quantity"), number(df, "UnitPrice"), amount_of(df)
    cancelled = F.col("IsCancellation") if "IsCancellation" in df.columns else is_cancelled()
    gaps = sum((is_missing(df, c).cast("long") for c in columns[1:]), is_missing(df, columns[0]).cast("long"))
    figures = df.agg(
        row_count().alias("row_count"),
        F.lit(len(columns)).cast("long").alias("column_count"),
        F.coalesce(F.sum(gaps), F.lit(0)).alias("total_missing"),
        F.count_if(F.col("CustomerID").isNull()).alias("missing_customer"),
        F.count_if(F.col("Description").isNull()).alias("missing_description"),
        F.count_if(qty < 0).alias("negative_quantity"),
        F.count_if(qty == 0).alias("zero_quantity"),
        F.count_if(price <= 0).alias("price_not_positive"),
        F.count_if(cancelled).alias("cancellations"),
        F.avg(amount).alias("amount_mean"),
        F.stddev_samp(amount).alias("amount_std"),
        F.sum(amount).alias("amount_sum"),
        *([F.count_if(F.col(copy) > 0).alias("duplicate_rows")] if copy else []),
    )
    repeats = F.col("duplicate_rows") if copy else F.col("row_count") - line_groups(df.select(*BASE_COLUMNS)).agg(row_count()).scalar()
    median = quantiles(melt(df.select(amount.alias("amount")), ["amount"]), {"median": 0.5}).scalar()
    return figures.select(
        F.lit(name).alias("dataset"),
        *[c for c in figures.columns if c != "duplicate_rows"],
        repeats.alias("duplicate_rows"),
        median.alias("amount_median"),
    )


def before_after(raw: DataFrame, cleaned: DataFrame, positive: DataFrame, copy: str | None = None) -> DataFrame:
    out = set_metrics("Raw dataset", raw, copy)
    out = out.unionByName(set_metrics("Cleaned (quality)", cleaned, copy))
    return out.unionByName(set_metrics("Positive-sales analytical", positive, copy))


def run_cleaning(df: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """Row sets, log and decisions; written to ``folder`` if one is given."""
    from tillroll.sources.sinks import save_cleaned, save_cleaning_log, save_table

    sets = cleaned_sets(df)
    out = {**sets, "cleaning_log": cleaning_log(df), "decision_table": cleaning_decisions(df)}
    if folder:
        save_cleaned(sets["flagged"], sets["cleaned"], sets["positive_sales"], folder)
        save_cleaning_log(out["cleaning_log"], folder)
        save_table(out["decision_table"], folder, "cleaning_decision_table", single_file=True)
    return out
