"""Benchmark: the parameter sweep on an .fvecs file, and headline queries on the given tables.

Prints one JSON line. The sweep input is made from the ``embeddings`` table before any
clock starts: 128 dimensions, a shared offset, and copies with noise of varied strength,
so that buckets are as crowded as in the published runs.

    BENCH_SF_DIR  table folder, default /root/testdata/sf0.1
    BENCH_CPUS    threads, default 8
    BENCH_NS      sweep sizes, default 1000,10000,50000,100000
    BENCH_LARGE   one more size, default 0 (none)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bandwise import queries as named
from bandwise.functions.simhash import with_simhash
from bandwise.operators.pairs import candidate_count
from bandwise.plans.sweep import sweep
from bandwise.session import local_session
from bandwise.sources.fvecs import read_fvecs

HEADLINE = ["simhash_signature", "candidate_count", "similar_pairs_k24", "quality_by_k", "near_duplicate_quality", "sweep_quality"]


def write_input(sf_dir: str, path: str, rows: int, dim: int = 128) -> None:
    table = pq.read_table(f"{sf_dir}/embeddings.parquet", columns=["embedding"])
    base = np.stack(table["embedding"].to_numpy()).astype("<f4")
    rng = np.random.default_rng(7)
    offset = rng.standard_normal(dim).astype("<f4")
    offset *= 2.0 / np.linalg.norm(offset)
    partner = rng.integers(0, len(base), len(base))
    with open(path, "wb") as out:
        for start in range(0, rows, 100_000):
            i = np.arange(start, min(rows, start + 100_000)) % len(base)
            strength = 0.1 * rng.random((len(i), 1)) ** 2
            noise = rng.standard_normal((len(i), dim)) * strength
            vectors = np.concatenate([base[i], base[partner[i]]], axis=1)[:, :dim] + offset + noise
            records = np.empty((len(i), dim + 1), dtype="<i4")
            records[:, 0] = dim
            records[:, 1:] = vectors.astype("<f4").view("<i4")
            records.tofile(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    ns = [int(n) for n in os.environ.get("BENCH_NS", "1000,10000,50000,100000").split(",")]
    large = int(os.environ.get("BENCH_LARGE", "0"))
    spark = local_session("bench")
    times: dict[str, float] = {}
    sizes: dict[str, dict] = {}

    def timed(name, run):
        started = time.perf_counter()
        result = run()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
        return result

    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        path = f"{folder}/vectors.fvecs"
        write_input(sf_dir, path, max(*ns, large))

        def first(n):
            return read_fvecs(spark, path, rows=n, partition_bytes=8 << 20)

        sweep(first(min(ns)), [min(ns)]).collect()  # start workers, compile

        def noop(df):
            df.write.format("noop").mode("overwrite").save()

        for n in ns:
            timed(f"signatures_n{n}", lambda: noop(with_simhash(first(n)).select("doc_id", "sig")))
            rows = timed(f"sweep_n{n}_b4_b8", lambda: sweep(first(n), [n]).collect())
            sizes[f"n{n}"] = {f"b{r.b}_k{r.k}": r.num_docs for r in rows}
        n = max(ns)
        signatures = with_simhash(first(n)).select("doc_id", "sig")
        rows = timed(f"candidates_n{n}_b4_b8", lambda: candidate_count(signatures, 64, [4, 8]).collect())
        sizes[f"candidates_n{n}"] = {f"b{r.b}": r.candidates for r in rows}
        timed("sweep_all_n_b4_b8", lambda: sweep(first(n), ns).collect())
        for name in HEADLINE:
            timed(name, lambda: noop(named.queries()[name](spark, sf_dir)))
        if large:
            rows = timed(f"sweep_n{large}_b4_b8", lambda: sweep(first(large), [large]).collect())
            sizes[f"n{large}"] = {f"b{r.b}_k{r.k}": r.num_docs for r in rows}
    print(
        json.dumps(
            {
                "metric": "total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": spark.sparkContext.defaultParallelism,
                "results": sizes,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
