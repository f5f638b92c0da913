"""Outputs of a run that appear together or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tallymark.sources import files

MANIFEST = "_RUN.json"  # readers of a folder pass over names with an underscore first


class Outputs:
    """Outputs written beside the place where they are to be, in a folder that nobody reads."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self.run = uuid.uuid4().hex
        self.folder = f"{out}/_staged-{self.run}"

    def path(self, name: str) -> str:
        """Where to write the output ``name``."""
        return f"{self.folder}/{name}"

    def parts(self, group: str, column: str, name: Mapping[int, str]) -> None:
        """What was written as ``group``, partitioned by a column of numbers, is the outputs that ``name`` names them."""
        for number, output in name.items():
            part = self.path(f"{group}/{column}={number}")
            if files.exists(self.spark, part):
                files.move(self.spark, part, self.path(output))

    def publish(self, main: str, names: Sequence[str], told: Mapping[str, object]) -> None:
        """Put what was written in the place of all that an earlier run left under ``names``.

        ``main`` goes first and comes last, with a manifest in it: while it is there, every output that its manifest lists is
        there too, of the same run. A driver lost in between leaves no ``main``, and the next run of the file mends that.
        """
        written = [name for name in dict.fromkeys((*names, main)) if files.exists(self.spark, self.path(name))]
        manifest = {**told, "run": self.run, "outputs": sorted(written)}
        files.write_text(self.spark, f"{self.folder}/{main}/{MANIFEST}", json.dumps(manifest, ensure_ascii=False, indent=1))
        for name in (main, *names):
            files.remove(self.spark, f"{self.out}/{name}")
        for name in sorted(written, key=lambda name: name == main):
            files.move(self.spark, f"{self.folder}/{name}", f"{self.out}/{name}")


@contextmanager
def outputs(spark: SparkSession, out: str) -> Iterator[Outputs]:
    """Outputs to be published inside the block. What was written and not published is removed at its end."""
    staged = Outputs(spark, out)
    try:
        yield staged
    finally:
        files.remove(spark, staged.folder)


def manifest(spark: SparkSession, out: str, main: str) -> dict | None:
    """What the run that made an output told about itself; None if there is no complete run."""
    text = files.read_text(spark, f"{out.rstrip('/')}/{main}/{MANIFEST}")
    return json.loads(text) if text else None
