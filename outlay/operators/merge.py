"""Project pull and the three-source PO merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nullif_blank
from ..params import INELIGIBLE_SCOPE_WORDS, SourceParams
from .precedence import desc_nulls_last, pick_by
from .rollup import COMMENT, DIRECT, UMBRELLA


def pull_projects(raw_projects: DataFrame, enrichment: DataFrame, params: SourceParams) -> DataFrame:
    """S1 + F13 + J1 + X1-X3: active program projects with enrichment.

    The left join fans out when the enrichment repeats a definition; every
    fanned-out row is kept, exactly like the extract.
    """
    rp = raw_projects.filter(
        F.upper("program_type").contains(params.program_token.upper()) & (F.col("is_active") == F.lit(True))
    )
    enr = enrichment.withColumnRenamed("proj_def", "e_proj_def")
    j = rp.join(enr, rp["proj_def"] == enr["e_proj_def"], "left")
    rid = F.col("record_id").cast("string")
    store = F.col("store_nbr").cast("string")
    firm = F.col("firm")
    return j.select(
        F.coalesce(F.col("entity_id").cast("string"), rid).alias("project_id"),
        F.col("program_type").alias("project_type"),
        store.alias("store"),
        F.coalesce(F.col("seq"), rid).alias("sequence"),
        F.coalesce(F.col("store_seq"), F.concat(store, F.lit("."), rid)).alias("store_sequence"),
        "city", "state", "project_status", "proj_def",
        F.coalesce(F.col("scope"), F.lit("")).alias("scope"),
        nullif_blank(F.col("contractor")).alias("general_contractor"),
        F.when(firm.isNotNull() & ~firm.isin("", "!Unknown"), firm).alias("gc_firm"),
        F.col("date_modified").alias("updated_at"),
        "actuals", "commitments", "contract", "contractor_po_amount",
        "created_date", "complete_date", "store_type",
        "comments_a", "comments_b",
        "record_id",
    )


def pull_order(prefix: str = "") -> list[Column]:
    """Total order of the pulled rows: modified desc (NULLs last), then ids."""
    return [desc_nulls_last(F.col(prefix + "updated_at")), F.col(prefix + "record_id"), F.col(prefix + "project_id")]


def store_key_map(pulled: DataFrame) -> DataFrame:
    """K5: store -> project definition.

    The last eligible project (active, scope without the ineligible words)
    in pull order wins; with none eligible the first one seen stays.
    """
    store, pd = F.col("store"), F.col("proj_def")
    scope = F.lower(F.coalesce(F.col("scope"), F.lit("")))
    dupe = F.lit(False)
    for w in INELIGIBLE_SCOPE_WORDS:
        dupe = dupe | scope.contains(w)
    eligible = ~dupe & (F.lower(F.coalesce(F.col("project_status"), F.lit(""))) == "active")
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(pull_order())])
    src = pulled.filter(store.isNotNull() & (store != "") & pd.isNotNull() & (pd != ""))
    return (
        src.groupBy("store")
        .agg(F.max_by(pd, F.when(eligible, key)).alias("_eligible"), F.min_by(pd, key).alias("_first"))
        .select("store", F.coalesce("_eligible", "_first").alias("proj_def"))
    )


def umbrella_mapped(umbrella: DataFrame, store_map: DataFrame, params: SourceParams) -> DataFrame:
    """X5 + J11: target store from item_text digits, else the line's store."""
    from_text = nullif_blank(F.regexp_extract(F.col("item_text"), params.item_store_regex, 1))
    u = umbrella.withColumn("real_store", F.coalesce(from_text, F.col("store_nbr").cast("string")))
    m = store_map.withColumnRenamed("store", "real_store")
    return u.join(m, "real_store", "left")  # proj_def NULL => skipped (counted by the audit)


def comment_po_map(pulled: DataFrame, params: SourceParams) -> DataFrame:
    """X6 + K6: PO number -> project definition mined from comments.

    The last project in pull order that mentions a PO wins; a longer digit
    run yields its first 8 digits.
    """
    c = F.coalesce(F.col("comments_a"), F.lit(""))
    src = pulled.filter((F.trim(c) != "") & F.col("proj_def").isNotNull() & (F.col("proj_def") != ""))
    refs = src.select(
        "proj_def", *[x.alias(f"_o{i}") for i, x in enumerate(pull_order())],
        F.posexplode(F.regexp_extract_all(c, F.lit(params.comment_po_regex), F.lit(1))).alias("_pos", "po_number"),
    )
    order = [F.col("_o0"), F.col("_o1"), F.col("_o2"), F.col("_pos")]
    return pick_by(refs.select("po_number", "proj_def", "_o0", "_o1", "_o2", "_pos"),
                   ["po_number"], order, last=True).select("po_number", "proj_def")


PO_COLUMNS = ["po_number", "proj_def", "vendor", "po_total", "invoiced_to_date", "remaining_to_invoice",
              "po_status", "created_date", "last_update"]


def place_umbrella(rolled: DataFrame, store_map: DataFrame, params: SourceParams) -> DataFrame:
    """X5 + J11 on the rows of all rollups: umbrella rows get ``real_store`` and its definition (NULL: skipped)."""
    is_umbrella = F.col("source_rank") == UMBRELLA
    from_text = nullif_blank(F.regexp_extract(F.col("item_text"), params.item_store_regex, 1))
    u = rolled.withColumn("real_store", F.when(is_umbrella, F.coalesce(from_text, F.col("store_nbr").cast("string"))))
    m = store_map.select(F.col("store").alias("real_store"), F.col("proj_def").alias("_mapped"))
    return u.join(m, "real_store", "left").withColumn(
        "proj_def", F.when(is_umbrella, F.col("_mapped")).otherwise(F.col("proj_def"))).drop("_mapped")


def by_po_number(rows: DataFrame, referenced: DataFrame | None = None) -> DataFrame:
    """U1 + K1 (+ J9/J10 through the source rank): the first row per PO number, with the rows it was chosen from counted.

    Sources rank direct, umbrella, comment. Within the direct source the
    newest created date wins, within the umbrella source the lowest store;
    vendor, item text and definition break the remaining ties. Umbrella rows
    without a definition are counted (``n_skipped``) and never win. A number
    that no line has, but that a comment refers to, has counts and a NULL ``source_rank``.

    A NULL number never collides inside the direct source, but an umbrella
    or comment row without number only enters when there is none yet. Direct
    rows without number so group by themselves, and a shadow of each competes
    in the group of the others: if a shadow wins there, that group is dropped.
    ``shared`` marks the groups that stand for a PO number; counts over them are exact.
    """
    cols = [*PO_COLUMNS, "source_rank", "store_nbr", "item_text"]
    rows = rows.select(*cols)
    rank = F.col("source_rank")
    own = F.struct(F.struct("proj_def", "vendor").alias("own"), F.lit(False).alias("shadow"))
    group = lambda shadow: F.struct(F.lit(None).cast("struct<proj_def:string,vendor:string>").alias("own"),
                                    F.lit(shadow).alias("shadow"))
    rows = rows.withColumn("_g", F.explode(
        F.when(F.col("po_number").isNull() & (rank == DIRECT), F.array(own, group(True))).otherwise(F.array(group(False)))))
    rows = rows.select(*cols, F.col("_g.own").alias("_own"), F.col("_g.shadow").alias("_shadow"))
    skipped = (rank == UMBRELLA) & F.col("proj_def").isNull()
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([
        rank, F.when(rank == DIRECT, desc_nulls_last(F.col("created_date"))), F.when(rank == UMBRELLA, F.col("store_nbr")),
        F.col("vendor"), F.col("item_text"), F.col("proj_def")])])
    first = F.min_by(F.struct(*[c for c in cols if c != "po_number"], "_shadow"), F.when(~skipped, order))
    count = lambda cond: F.count(F.when(cond, 1))
    out = rows.groupBy("po_number", "_own").agg(
        first.alias("_row"), count(rank == DIRECT).alias("n_direct"),
        count((rank == UMBRELLA) & ~skipped).alias("n_mapped"), count(skipped).alias("n_skipped"),
        count(rank == COMMENT).alias("n_comment"))
    seen = [c for c in out.columns if c.startswith("n_")]
    if referenced is None:
        out = out.withColumn("n_referenced", F.lit(0).cast("long"))
    else:  # joined by number, which leaves the rows where they are
        refs = referenced.groupBy(F.col("po_number").alias("_ref")).agg(F.count(F.lit(1)).alias("n_referenced"))
        out = out.join(refs, (F.col("po_number") == F.col("_ref")) & F.col("_own").isNull(), "full").withColumn(
            "po_number", F.coalesce("po_number", "_ref"))
    return out.select("po_number", "_row.*", F.col("_own").isNull().alias("shared"),
                      *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (*seen, "n_referenced")])


def winners(groups: DataFrame) -> DataFrame:
    """The merged POs of ``by_po_number``."""
    return groups.filter(F.col("source_rank").isNotNull() & ~F.col("_shadow")).select(
        "po_number", *PO_COLUMNS[1:], "source_rank", "store_nbr", "item_text")


def merge_figures() -> dict[str, Column]:
    """A27 figures of the merge, as aggregates over ``by_po_number``; their names are (stage, metric)."""
    shared, known = F.col("shared"), (F.col("n_direct") > 0) | (F.col("n_mapped") > 0)
    total = lambda *cs: F.coalesce(F.sum(F.when(shared, sum(map(F.col, cs), F.lit(0)))), F.lit(0))
    count = lambda cond: F.count(F.when(shared & cond, 1))
    return {
        "pull.direct_po_rows": total("n_direct"), "umbrella.raw_rows": total("n_mapped", "n_skipped"),
        "umbrella.mapped": total("n_mapped"), "umbrella.skipped": total("n_skipped"),
        "merge.umbrella_new": count((F.col("n_direct") == 0) & (F.col("n_mapped") > 0)),
        "comment.referenced": total("n_referenced"), "comment.missing": count((F.col("n_referenced") > 0) & ~known),
        "merge.comment_new": count(~known & (F.col("n_comment") > 0))}


def merge_sources(direct: DataFrame, umbrella: DataFrame, comment: DataFrame) -> DataFrame:
    """U1 + K1 of three separate sources, see ``by_po_number``."""
    def ranked(df: DataFrame, rank: int) -> DataFrame:
        extra = [F.lit(rank).alias("source_rank"), *[
            F.col(c) if rank == UMBRELLA else F.lit(None).cast(t).alias(c)
            for c, t in (("store_nbr", "long"), ("item_text", "string"))]]
        return df.select(*PO_COLUMNS, *extra)

    return winners(by_po_number(ranked(direct, DIRECT).unionByName(ranked(umbrella, UMBRELLA)).unionByName(
        ranked(comment, COMMENT))))
