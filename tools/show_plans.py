"""Print the final adaptive physical plan (tree only) of catalog queries.

Usage: python tools/show_plans.py sf_dir name [name ...]
Each query is collected once, so the plan shown is the one that ran.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from tripmart.plans import catalog
    from tripmart.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    qs = catalog.queries()
    for name in names:
        df = qs[name](spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("== Final Plan ==")[1].split("+- == Initial Plan ==")[0]
        print(f"### `{name}`\n\n```\n{tree.strip()}\n```\n")


if __name__ == "__main__":
    main()
