"""What was stored against what was sent."""


from pyspark.sql import functions as F

from ledgerline.functions import named

# Two seeds give 128 bits per row; only rows of one identifier are ever compared.
_SEEDS = (1, 2)


def row_key(columns):
    """Two hashes of a row. Nulls leave a hash unchanged, so null flags are hashed too."""
    flagged = [part for c in columns for part in (named(c).isNull(), named(c))]
    return {
        f"__h{seed}": F.xxhash64(F.lit(seed), *flagged) for seed in _SEEDS
    }


def common_types(sent, stored, columns):
    """Column types that hold the values of both sides, as a union would choose them."""
    names = [named(c) for c in columns]
    return sent.select(*names).unionByName(stored.select(*names)).schema


def compare_by_identifier(sent, stored, identifier, exact=False):
    """Per identifier: rows sent, rows stored, and whether their contents differ.

    Both sides go through one union and one grouping instead of two anti-joins and a
    difference of sets. The first grouping counts equal rows, the second folds them per
    identifier; both combine on the map side, so a hot identifier spreads over its
    distinct rows first and then costs one row per map task. Both sides are cast to their
    common types first, so an int that was stored as a long is unchanged. Rows are grouped
    by a 128-bit key, so it is hashes that are compared, or by all their columns with
    ``exact=True``.
    """
    columns = sent.columns
    common = common_types(sent, stored, columns)

    def side(df, n_sent, n_stored):
        rows = df.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in common.fields])
        if not exact:
            rows = rows.select(named(identifier), *[
                c.alias(name) for name, c in row_key(columns).items()
            ])
        return rows.withColumns({"__sent": F.lit(n_sent), "__stored": F.lit(n_stored)})

    both = side(sent, 1, 0).unionByName(side(stored, 0, 1))
    keys = [c for c in both.columns if c not in ("__sent", "__stored")]
    per_row = both.groupBy(*[named(k) for k in keys]).agg(
        F.sum("__sent").alias("__sent"), F.sum("__stored").alias("__stored")
    )
    return per_row.groupBy(named(identifier)).agg(
        F.sum("__sent").alias("n_sent"),
        F.sum("__stored").alias("n_stored"),
        F.sum(F.greatest(F.col("__sent") - F.col("__stored"), F.lit(0))).alias("n_not_stored"),
    )


def reconcile(sent, stored, identifier, exact=False):
    """One row of counts.

    ``n_missing``: identifiers sent but not stored; ``n_extra``: stored but not sent;
    ``n_duplicate``: stored more than once; ``n_changed``: on both sides, but some row
    that was sent is not stored.
    """
    ids = compare_by_identifier(sent, stored, identifier, exact)
    was_sent, was_stored = F.col("n_sent") > 0, F.col("n_stored") > 0
    return ids.agg(
        F.coalesce(F.sum("n_sent"), F.lit(0)).alias("n_sent"),
        F.coalesce(F.sum("n_stored"), F.lit(0)).alias("n_stored"),
        F.count_if(was_sent & ~was_stored).alias("n_missing"),
        F.count_if(~was_sent & was_stored).alias("n_extra"),
        F.count_if(F.col("n_stored") > 1).alias("n_duplicate"),
        F.count_if(was_sent & was_stored & (F.col("n_not_stored") > 0)).alias("n_changed"),
    )
