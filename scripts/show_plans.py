"""Print the physical plans of the headline queries over a saved index.

    python scripts/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexis.operators.bm25 import bm25_search  # noqa: E402
from lexis.operators.boolean import boolean_search  # noqa: E402
from lexis.operators.index import build_index, weighted_postings  # noqa: E402
from lexis.operators.store import save_index
from lexis.operators.lsa import lsa_search  # noqa: E402
from lexis.operators.tokens import parse_queries  # noqa: E402
from lexis.operators.vector import cosine_search  # noqa: E402
from lexis.profile import LATIN  # noqa: E402
from lexis.session import get_spark, scratch_path  # noqa: E402
from lexis.sources.corpus import benchmark_queries, documents  # noqa: E402

KEEP = ("Exchange", "Aggregate", "Join", "Window", "Generate", "Scan", "MapInArrow",
        "FlatMapGroups", "Sort ", "Filter", "Project", "BroadcastExchange")


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            out.append(line[:150])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    idx = save_index(build_index(documents(spark, sf_dir), LATIN), scratch_path(spark, "plans"))
    q = parse_queries(benchmark_queries(spark, sf_dir), LATIN).cache()
    q.count()
    print("# Physical plans (saved, bucketed index; query batch cached)\n")
    print("Generated by `scripts/show_plans.py`. Candidate rows never cross an Exchange: the only\n"
          "exchanges carry the query batch, <= k rows per query per task (top-k), Gram cells or\n"
          "dictionary partials.\n")
    for name, df in [("index build: postings (per document, no shuffle)",
                      build_index(documents(spark, sf_dir), LATIN).postings),
                     ("bm25_batch", bm25_search(idx, q)), ("cosine_batch", cosine_search(idx, q)),
                     ("boolean_batch", boolean_search(idx, q)), ("tf_idf", weighted_postings(idx)),
                     ("lsa_batch", lsa_search(idx, q))]:
        if name.startswith("index"):
            plan = df._jdf.queryExecution().executedPlan().toString()
            body = "\n".join(line[:150] for line in plan.split("\n") if line.strip())
        else:
            df.write.format("noop").mode("overwrite").save()   # final adaptive plan
            body = tree(df)
        print(f"## {name}\n\n```\n{body}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
