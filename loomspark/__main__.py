"""python -m loomspark list | run QUERY FOLDER [OUT]: names of the queries; run one over a folder of tables."""

from __future__ import annotations

import sys


def main(args: list[str]) -> int:
    from loomspark.plans.catalogue import QUERIES

    if args == ["list"]:
        print(*QUERIES, sep="\n")
        return 0
    if len(args) in (3, 4) and args[0] == "run" and args[1] in QUERIES:
        from loomspark.session import session

        df = QUERIES[args[1]](session(), args[2])
        if len(args) == 4:
            df.write.mode("overwrite").parquet(args[3])
        else:
            df.show(20, truncate=80)
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
