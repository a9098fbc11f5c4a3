"""``spark-submit`` entry: run one registered query and replace its output.

    spark-submit winback/plans/submit.py <query> <input_dir> <output_path>

The session comes from the cluster (master, executors and the shared
``spark.checkpoint.dir`` are the cluster's); SQL settings from
``session.cluster_conf`` are applied, sized from the input volume, unless the
cluster already set them (static ones, such as checkpoint cleaning, go on the
``spark-submit --conf`` line). The result replaces the table under the output path
(``io.write_table``): a new version and one swap, read with ``io.read_table``; a failing
run leaves the old table.
"""

from __future__ import annotations

import os
import sys


def _input_bytes(spark, path: str) -> int:
    """Bytes under ``path`` on any Hadoop filesystem (HDFS, object stores,
    local), from the file system's content summary."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def main(argv: list[str]) -> None:
    if len(argv) != 3:
        raise SystemExit(__doc__)
    name, input_dir, output_path = argv
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__)))))
    from pyspark.sql import SparkSession

    from winback.plans.queries import REGISTRY
    from winback.session import cluster_conf, ensure_checkpoint_dir
    from winback.sources.io import write_table

    spark = SparkSession.builder.appName(f"winback-{name}").getOrCreate()
    cores = spark.sparkContext.defaultParallelism
    for k, v in cluster_conf(_input_bytes(spark, input_dir), cores).items():
        if spark.conf.get(k, None) in (None, "") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)   # static ones belong on the spark-submit line
    ensure_checkpoint_dir(spark)
    write_table(REGISTRY[name](spark, input_dir), output_path)


if __name__ == "__main__":
    main(sys.argv[1:])
