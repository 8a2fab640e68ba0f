"""Number of partitions for record-wise work."""

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def parallelism(spark):
    """``spark.default.parallelism`` where configured, else what the cluster offers."""
    return spark.sparkContext.defaultParallelism


def _operators(plan):
    """The class names of the operators of a physical plan, also of one that adapts."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _operators(plan.executedPlan())
        return
    yield name
    children = plan.children()
    for i in range(children.size()):
        yield from _operators(children.apply(i))


def spread_for_puts(df):
    """``df`` in at least as many partitions as the cluster works on at once.

    Only an input that is read in few partitions is spread; many are left as they are, so
    a retried task repeats few puts. Behind a shuffle or a cached table nothing is
    counted, since counting would run what is above it; AQE has sized those partitions.
    """
    operators = _operators(df._jdf.queryExecution().executedPlan())
    if any("Exchange" in name or name == "InMemoryTableScanExec" for name in operators):
        return df
    wanted = parallelism(df.sparkSession)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def bounded_repartition(df, num_partitions=None):
    """Bring the partitions to the parallelism, if too few or too many for it.

    Too few: an even shuffle spreads the rows. Too many (more than the shuffle
    partitions): partitions are joined in place, which needs no shuffle. In between
    ``df`` is returned as it is.

    ``num_partitions`` is the current number where the caller knows it. Spark has to run
    the shuffles above a partition count to know it, so pass it for such inputs.
    """
    spark = df.sparkSession
    wanted = parallelism(spark)
    upper = int(spark.conf.get(SHUFFLE_PARTITIONS))
    current = df.rdd.getNumPartitions() if num_partitions is None else num_partitions
    if current < wanted:
        return df.repartition(wanted)
    if current > upper:
        return df.coalesce(wanted)
    return df
