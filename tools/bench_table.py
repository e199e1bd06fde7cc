"""Render bench.py JSON lines (one per scale factor) as a markdown table.

    python tools/bench_table.py sf0.01.json sf0.1.json
"""

from __future__ import annotations

import json
import sys


def main(paths: list[str]) -> None:
    runs = [json.loads(open(p).read().strip().splitlines()[-1]) for p in paths]
    names = list(runs[-1]["queries"])
    print("| query | " + " | ".join(f"sf{r['sf']} (s)" for r in runs) + " |")
    print("| --- | " + " | ".join("---:" for _ in runs) + " |")
    for n in names:
        print(f"| `{n}` | " + " | ".join(f"{r['queries'].get(n, float('nan')):.2f}" for r in runs) + " |")
    print("| **total** | " + " | ".join(f"**{r['value']:.1f}**" for r in runs) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])
