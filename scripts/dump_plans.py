"""Write ``explain("formatted")`` of chosen queries to docs/plans/<name>.txt."""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexiflow.plans import catalog  # noqa: E402
from lexiflow.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1]
    names = sys.argv[2:]
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    spark = build_session("local[8]", 16)
    for n in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            catalog.QUERIES[n](spark, sf).explain("formatted")
        with open(os.path.join(out_dir, f"{n}.txt"), "w") as f:
            f.write(buf.getvalue())
        print(n, len(buf.getvalue()))


if __name__ == "__main__":
    main()
