"""Versioned output folders: readers see whole versions, a failed run goes on where it stopped.

    folder/versions/NAME/...          all outputs of one run
    folder/versions/NAME/_run.json    what the run was started with
    folder/versions/NAME/_stages/...  one manifest per finished stage
    folder/commits/00000007.json      which version is published

A run writes into a version of its own and publishes it by one small commit file, so
the version before stays whole and readable until, and after, that moment. The
greatest commit counts. Commit files are only ever created: of two runs that end
together, one fails instead of hiding the other.

A stage's manifest is written after its outputs. A later run with the same inputs and
parameters takes up the unpublished version and skips the stages that have one.

All files go through Hadoop's file systems, so any storage that Spark writes to will do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

VERSIONS, COMMITS, STAGES, RUN = "versions", "commits", "_stages", "_run.json"
#: Published versions that are kept, and days after which an unpublished one counts as abandoned.
KEEP = 2
ABANDONED_DAYS = 14.0


class Folder:
    """Small files and folders below a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def read(self, name: str) -> dict | None:
        """The JSON in a file; None where the file is missing or was not written to its end."""
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:
            return None
        finally:
            stream.close()

    def create(self, name: str, value: dict, replace: bool = False) -> None:
        """Write JSON to a new file; one that is there already is an error unless ``replace``."""
        try:
            stream = self._fs.create(self._at(name), replace)
        except Py4JJavaError as error:
            raise FileExistsError(f"{self.path}/{name}") from error
        stream.write(bytearray(json.dumps(value, sort_keys=True, indent=1).encode()))
        stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def age(self, name: str) -> float:
        """Seconds since the file was written."""
        return time.time() - self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def listing(self, name: str = "") -> list[list]:
        """Path, length and time of every file below, hidden ones left out: equal while the files are."""
        found = []
        if self._fs.exists(self._at(name)):
            files = self._fs.listFiles(self._at(name), True)
            root = self._fs.makeQualified(self._at(name)).toUri().getPath()
            while files.hasNext():
                f = files.next()
                path = f.getPath().toUri().getPath()[len(root) :]
                if not any(part.startswith((".", "_")) for part in path.split("/")):
                    found.append([path, f.getLen(), f.getModificationTime()])
        return sorted(found)


@dataclass
class Version:
    """One version of the outputs: being written, or published."""

    folder: Folder
    name: str
    skipped: list[str] = field(default_factory=list)

    @property
    def path(self) -> str:
        return f"{self.folder.path}/{VERSIONS}/{self.name}"

    def _manifest(self, stage: str) -> str:
        return f"{VERSIONS}/{self.name}/{STAGES}/{stage}.json"

    def stages(self) -> list[str]:
        """Names of the finished stages."""
        return [n.removesuffix(".json") for n in self.folder.names(f"{VERSIONS}/{self.name}/{STAGES}")]

    def facts(self, stage: str) -> dict | None:
        """What a finished stage has returned."""
        return self.folder.read(self._manifest(stage))

    def uses(self) -> list[str]:
        """Versions whose files this one reads: they stay as long as it does."""
        return (self.folder.read(f"{VERSIONS}/{self.name}/{RUN}") or {}).get("uses", [])

    def stage(self, name: str, work: Callable[[], dict]) -> dict:
        """The facts that ``work`` returns, or that it returned to an earlier run of this version.

        ``work`` writes its outputs below ``path`` and may find half of them there.
        """
        done = self.facts(name)
        if done is not None:
            self.skipped.append(name)
            return done
        facts = work()
        self.folder.create(self._manifest(name), facts, replace=True)
        return facts

    def publish(self, keep: int = KEEP, abandoned_days: float = ABANDONED_DAYS) -> None:
        """Make this the version that readers see; then remove versions no longer needed.

        Kept are the last ``keep`` published ones and unpublished ones of the last days.
        """
        commits = _commits(self.folder)
        last = max(commits, default=0)
        if commits.get(last) != self.name:
            last += 1
            entry = {"version": self.name, "stages": self.stages()}
            self.folder.create(f"{COMMITS}/{last:08d}.json", entry)
            commits[last] = self.name
        held = {commits[n] for n in sorted(commits)[-max(keep, 1) :]}
        held |= {used for name in held for used in Version(self.folder, name).uses()}
        published = set(commits.values())
        for name in self.folder.names(VERSIONS):
            run = f"{VERSIONS}/{name}/{RUN}"
            if name in held:
                continue
            if name in published or (
                self.folder.read(run) is not None and self.folder.age(run) > abandoned_days * 86400
            ):
                self.folder.delete(f"{VERSIONS}/{name}")


def _commits(folder: Folder) -> dict[int, str]:
    """Version by commit number; a commit that was not written to its end does not count."""
    found = {}
    for name in folder.names(COMMITS):
        number = name.removesuffix(".json")
        entry = folder.read(f"{COMMITS}/{name}") if number.isdigit() else None
        if entry is not None:
            found[int(number)] = entry["version"]
    return found


def published(spark: SparkSession, path: str) -> Version | None:
    """The version that readers of the folder ``path`` should read; None before the first."""
    folder = Folder(spark, path)
    commits = _commits(folder)
    return Version(folder, commits[max(commits)]) if commits else None


def open_version(spark: SparkSession, path: str, run: dict) -> Version:
    """The unpublished version below ``path`` that was started with an equal ``run``, else a new one.

    ``run`` tells inputs and parameters (JSON values): outputs of other ones are never mixed. Its
    entry ``uses`` names the versions whose files the new one will read.
    """
    folder = Folder(spark, path)
    done = set(_commits(folder).values())
    run = json.loads(json.dumps(run))
    for name in reversed(folder.names(VERSIONS)):
        if name not in done and folder.read(f"{VERSIONS}/{name}/{RUN}") == run:
            return Version(folder, name)
    name = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    folder.create(f"{VERSIONS}/{name}/{RUN}", run)
    return Version(folder, name)
