"""The batch job: read reviews, rank them in one mode, write the result.

Command line (same eight arguments as the original job, in order)::

    spark-submit peerrank/plans/job.py MODE DEMO INPUT OUTPUT LAMBDA ITER PARTITIONS TIMEOUT

MODE is ``General`` or ``Product``.  DEMO=true also writes the per-iteration
trace (parquet by iteration) and the run log (text marker lines) next to
the output.  TIMEOUT only paced a browser demo and is accepted but unused.
"""

from __future__ import annotations

import os
import sys
from contextlib import nullcontext
from dataclasses import dataclass

if not __package__:  # run as a script: the package is two folders up
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerrank.operators.general import general_rank
from peerrank.operators.links import general_links, product_link_pairs
from peerrank.operators.product import product_rank, product_rows
from peerrank.session import ENGINE_CONF, cut_lineage, ensure_checkpoint_dir, path_exists, scratch_run
from peerrank.sources.reviews import load_reviews
from peerrank.sources.runlog import runlog_lines
from peerrank.sources.sinks import read_result, write_result

MODES = ("General", "Product")


@dataclass
class JobResult:
    ranks: DataFrame
    trace: DataFrame | None = None


def rank_reviews(reviews: DataFrame, mode: str, lam: float = 20, iters: int = 10, partitions: int | None = None,
                 trace: bool = False, checkpoint_every: int | None = None) -> DataFrame:
    """Ranks in one mode; ``checkpoint_every`` defaults to each mode's own."""
    extra = {} if checkpoint_every is None else {"checkpoint_every": checkpoint_every}
    if mode == "General":
        return general_rank(reviews, lam, iters, partitions, trace=trace, **extra)
    if mode == "Product":
        return product_rank(reviews, lam, iters, partitions, trace=trace, **extra)
    raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")


def rank_job(spark: SparkSession, mode: str, input_path: str, output_path: str, lam: float = 20, iters: int = 10,
             partitions: int | None = None, demo: bool = False, write_mode: str = "errorifexists",
             single_file: bool = False, drop_scratch: bool = False) -> JobResult:
    """Ranks the reviews of ``input_path`` into ``output_path``.  With
    ``drop_scratch`` the job's scratch data (a run of its own) is deleted at the
    end, whatever happened, and the result's ranks are read from the output."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    if write_mode in ("error", "errorifexists"):
        for target in [output_path, *([f"{output_path}_trace", f"{output_path}_runlog"] if demo else [])]:
            if path_exists(spark, target):
                raise FileExistsError(f"output exists: {target}")
    ensure_checkpoint_dir(spark)
    with scratch_run(spark) if drop_scratch else nullcontext():
        result = _rank_job(spark, mode, input_path, output_path, lam, iters, partitions, demo, write_mode, single_file)
    return JobResult(ranks=read_result(spark, output_path)) if drop_scratch else result


def _rank_job(spark: SparkSession, mode: str, input_path: str, output_path: str, lam: float, iters: int,
              partitions: int | None, demo: bool, write_mode: str, single_file: bool) -> JobResult:
    reviews = load_reviews(spark, input_path)
    trace = None
    if demo:
        trace = rank_reviews(reviews, mode, lam, iters, partitions, trace=True)
        ranks = trace.filter(F.col("iter") == iters).select("user_id", "rank_q", "rank")
        if mode == "General":
            links = cut_lineage(general_links(reviews))
        else:
            links = cut_lineage(product_link_pairs(product_rows(reviews, partitions)))
        trace.write.mode(write_mode).partitionBy("iter").parquet(f"{output_path}_trace")
        runlog_lines(trace, links).write.mode(write_mode).text(f"{output_path}_runlog")
    else:
        ranks = rank_reviews(reviews, mode, lam, iters, partitions)
    write_result(ranks, output_path, mode=write_mode, single_file=single_file, float_text=True)
    return JobResult(ranks=ranks, trace=trace)


def main(argv: list[str]) -> int:
    if len(argv) < 7:
        print(__doc__, file=sys.stderr)
        return 2
    mode, demo, input_path, output_path, lam, iters, partitions = argv[:7]
    builder = SparkSession.builder.appName("peerrank")
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    # bucketed intermediates and shuffles must agree on the partition count
    # for co-partitioned joins
    builder = builder.config("spark.sql.shuffle.partitions", str(int(partitions)))
    spark = builder.getOrCreate()
    rank_job(spark, mode, input_path, output_path, float(lam), int(iters), int(partitions),
             demo=demo.lower() == "true", drop_scratch=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
