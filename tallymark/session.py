"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from functools import wraps

from pyspark import InheritableThread, SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallymark", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, else below the session's warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallymark-scratch"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one; nothing else writes to it, and it goes when the session's JVM ends."""
    run = f"{shared_folder(spark).rstrip('/')}/tallymark-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(run)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{run}/{label}-{uuid.uuid4().hex}"


def side_by_side(*tasks: Callable[[], object]) -> list:
    """What the tasks return, in their order. They run at once, so the jobs of one fill the cores that another leaves idle;
    all have ended before an error of one is raised."""
    results: list = [None] * len(tasks)
    errors: list[BaseException] = []

    def run(n: int) -> None:
        try:
            results[n] = tasks[n]()
        except BaseException as problem:  # noqa: BLE001 - raised below, in the thread that asked
            errors.append(problem)

    others = [InheritableThread(target=run, args=(n,)) for n in range(1, len(tasks))]  # they keep the caller's job group
    for thread in others:
        thread.start()
    run(0)
    for thread in others:
        thread.join()
    if errors:
        raise errors[0]
    return results


def built_once(build: Callable) -> Callable:
    """For columns that only their arguments decide: made once per Spark context and then used again by every batch.
    A set of columns takes thousands of calls into the JVM, which a stream of many batches would repeat."""
    found: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

    @wraps(build)
    def get(*args):
        mine = found.setdefault(SparkContext._active_spark_context, {})
        if args not in mine:
            mine[args] = build(*args)
        return mine[args]

    return get


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
