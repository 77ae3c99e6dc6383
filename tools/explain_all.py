"""Write the physical plan tree of every registered query to PLANS.md.

usage: python tools/explain_all.py [sf_dir]
Only the operator tree of ``explain("formatted")`` is kept (the numbered
details are omitted); counts of exchanges and broadcasts are listed first.
"""

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = ["# Physical plans", "", f"Generated by `tools/explain_all.py` on `{sf}` (local[8], AQE on; "
           "the initial plan, before AQE re-optimisation). Queries that materialise intermediate "
           "results (checkpoints of keyed scans, iterative rounds) show the plan of their last "
           "step, which starts from the checkpointed data.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        n_ex = len(re.findall(r"Exchange(?! SinglePartition)", tree)) - len(re.findall(r"BroadcastExchange", tree))
        n_bc = len(re.findall(r"BroadcastExchange", tree))
        out += [f"## {name}", "", f"shuffle exchanges: {n_ex}, broadcasts: {n_bc}", "", "```", tree.strip(), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
