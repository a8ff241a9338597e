"""python -m filigree list | run QUERY FOLDER [OUT] | explain QUERY FOLDER: the catalogue from a shell."""

from __future__ import annotations

import sys


def main(args: list[str]) -> int:
    from filigree.plans import registry

    queries = registry.queries()
    if args[:1] == ["list"]:
        print("\n".join(f"{name}{'' if name in registry.oracle_sql() else '  (no SQL)'}" for name in sorted(queries)))
        return 0
    if len(args) < 3 or args[0] not in ("run", "explain") or args[1] not in queries:
        print(__doc__, file=sys.stderr)
        return 2
    from filigree.runtime import clear_staged, local_session

    spark = local_session()
    df = queries[args[1]](spark, args[2])
    if args[0] == "explain":
        df.explain("formatted")
    elif len(args) > 3:
        df.write.mode("overwrite").parquet(args[3])
    else:
        df.show(20, truncate=80)
    clear_staged(spark)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
