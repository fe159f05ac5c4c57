"""Write the physical plans of the headline queries to PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
The fits run (they are jobs); what is printed is the plan of the returned
DataFrame, i.e. the apply / query step that scales with the data.
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, ".")
from featuremap.plans import catalog  # noqa: E402
from featuremap.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` at `{sf}` (local mode, AQE on; "
           "`isFinalPlan=false` plans as planned before execution).", ""]
    for n in catalog.HEADLINE:
        df = catalog.QUERIES[n](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        full = buf.getvalue()
        tree = full.split("\n\n(1)")[0]                    # the operator tree
        keep = ("(", "ReadSchema", "PushedFilters", "Join type", "Keys", "Functions",
                "Arguments: hashpartitioning", "Arguments: HashedRelation")
        details = [ln for ln in full.split("\n\n(1)", 1)[-1].splitlines()
                   if ln.startswith(keep) and "codegen" not in ln or ln.startswith(("ReadSchema",))]
        out += [f"## {n}", "", "```", tree.strip(), "", "(1)" + "\n".join(details), "```", ""]
    open("PLANS.md", "w").write("\n".join(out))


if __name__ == "__main__":
    main()
