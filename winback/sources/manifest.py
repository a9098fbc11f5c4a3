"""Run manifest: which stages of a job are complete, so that a restarted run goes
on behind them (ML-14).

A stage is told by its name and a fingerprint of its parameters, of the library's own
source files, and of the stages and input files it reads. Its output goes to a folder of that fingerprint; the record
is written after the output, by one rename. A killed stage leaves no record and is
run again over its half-written folder; changed parameters or inputs give another
fingerprint, so nothing stale is taken up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import cache
from importlib import resources

from pyspark.sql import SparkSession

from winback.sources.io import Files

RECORDS = "_manifest"


@cache
def code_fingerprint() -> str:
    """Hash of the source files whose results are recorded."""
    root, h = resources.files("winback"), hashlib.sha256()
    for part in ("functions", "operators", "plans", "sources"):
        for f in sorted(root.joinpath(part).iterdir(), key=lambda f: f.name):
            if f.name.endswith(".py"):
                h.update(f.read_bytes())
    return h.hexdigest()[:16]


class RunManifest:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._records = Files(spark, f"{self.base}/{RECORDS}")

    def fingerprint(self, name: str, params: object, after: tuple[str, ...] = ()) -> str:
        known = [name, code_fingerprint(), params, list(after)]
        return hashlib.sha256(json.dumps(known, sort_keys=True, default=str).encode()).hexdigest()[:24]

    def inputs(self, paths: list[str]) -> str:
        """Fingerprint of the files below ``paths``."""
        return self.fingerprint("inputs", [Files(self.spark, p).fingerprint() for p in paths])

    def output(self, name: str, key: str) -> str:
        return f"{self.base}/{name}-{key}"

    def complete(self, name: str, key: str) -> bool:
        return self._records.exists(f"{name}-{key}")

    def stage(self, name: str, params: object, after: tuple[str, ...], make: Callable[[str], object]) -> tuple[str, str]:
        """Run ``make(output path)`` unless recorded; (output path, fingerprint)."""
        key = self.fingerprint(name, params, after)
        out = self.output(name, key)
        if not self.complete(name, key):
            make(out)
            self._records.write(f"{name}-{key}", json.dumps({"stage": name, "params": params, "after": after, "output": out},
                                                            sort_keys=True, default=str))
        return out, key

    def stages(self) -> list[dict]:
        """The records, by name."""
        return [json.loads(self._records.read(n)) for n in self._records.names() if not n.startswith((".", "_"))]
