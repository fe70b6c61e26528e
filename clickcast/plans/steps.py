"""The steps of a job that are done, so that a second call goes on behind the last whole one."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from clickcast.session import empty_folder, read_text, write_text


class Steps:
    """A manifest per step below ``folder``: what the job was asked for, what the step has written, and its rows.

    A step counts as done if its manifest is there, which is written after all else of the step, and was written for the
    same ``asked``. Once a step runs, all behind it run. Without ``resume`` all run, and old manifests go first.
    """

    def __init__(self, spark: SparkSession, folder: str, asked: dict, resume: bool):
        self.spark, self.folder = spark, folder
        self.asked = hashlib.sha256(json.dumps(asked, sort_keys=True, default=str).encode()).hexdigest()
        self.resuming = resume
        self.done: list[str] = []
        if not resume:
            empty_folder(spark, folder)

    def run(self, name: str, work: Callable[[], dict]) -> dict:
        """What ``work`` gives: facts about what it has written, from the manifest if it was done before."""
        path = f"{self.folder}/{name}.json"
        known = json.loads(read_text(self.spark, path) or "null") if self.resuming else None
        if known is not None and known["asked"] == self.asked:
            self.done.append(name)
            return known["made"]
        self.resuming = False
        made = work()
        write_text(self.spark, path, json.dumps({"step": name, "asked": self.asked, "made": made}))
        return made
