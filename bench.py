"""Time the headline jobs; prints one JSON line.

Every job writes all its rows to a sink that drops them. The first run of a job
warms up, the better of two further runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "plaintext_chunks", "plaintext_chunk_text", "csv_chunks", "jsonl_chunks", "yaml_chunks",
    "toml_chunks", "markdown_chunks", "html_chunks", "code_chunks", "size_ranges_code",
    "requirement_sentences", "bm25_topk", "bm25_postings", "stored_postings_search", "phrase_match", "fts_terms",
    "like_match", "vector_topk", "vector_filtered", "hybrid_rrf", "hybrid_weighted",
    "retrieve_topk", "rerank_lexical", "passage_search", "upsert_merge", "upsert_latest",
    "delete_paths", "changes_latest", "changed_chunks",
]


def main() -> None:
    from lodestone.plans.catalog import QUERIES
    from lodestone.session import local_session

    spark = local_session(CPUS, partitions=int(CPUS))
    times: dict[str, float] = {}
    for name in HEADLINES:
        best = float("inf")
        for run in range(3):
            began = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            if run:
                best = min(best, time.perf_counter() - began)
        times[name] = round(best, 3)
        print(f"{name} {best:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of the headline jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(FOLDER).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
