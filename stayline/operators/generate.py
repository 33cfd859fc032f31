"""Text per row from a caller's generator, paid for once."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class AnswerStore:
    """Answers below a folder that all executors share: one file per prompt, named by its SHA-256.

    A file appears whole or not at all, so a task that is run again, on whatever machine, finds
    every answer that was received before.
    """

    folder: str

    def _place(self, prompt: str) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.folder)
        name = hashlib.sha256(prompt.encode()).hexdigest()
        return store, f"{root}/{name[:2]}/{name}"

    def find(self, prompt: str) -> str | None:
        store, path = self._place(prompt)
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_file(path) as file:
            return file.read().decode()

    def keep(self, prompt: str, answer: str) -> None:
        store, path = self._place(prompt)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(answer.encode())
        store.move(part, path)


def answer(
    prompt: str,
    generate: Callable[[str], str],
    fallback: str,
    pause_seconds: float = 0.0,
    answers: AnswerStore | None = None,
    attempts: int = 1,
    backoff_seconds: float = 1.0,
) -> str:
    """The stored answer, else ``generate(prompt)`` stripped, else ``fallback``.

    A call that fails is tried again up to ``attempts`` times, after ``backoff_seconds``, then twice
    that, and so on. Only answers are stored, no fallbacks. ``pause_seconds`` follows every call.
    """
    text = answers.find(prompt) if answers else None
    if text is not None:
        return text
    for again in range(attempts):
        try:
            text = generate(prompt).strip()
        except Exception:
            if again + 1 < attempts:
                time.sleep(backoff_seconds * 2**again)
            continue
        if answers:
            answers.keep(prompt, text)
        if pause_seconds:
            time.sleep(pause_seconds)
        return text
    return fallback


def add_generated_text(
    df: DataFrame,
    prompt: str,
    output: str,
    generate: Callable[[str], str],
    fallback: str,
    pause_seconds: float = 0.0,
    tasks: int | None = None,
    answers: AnswerStore | None = None,
    attempts: int = 1,
    backoff_seconds: float = 1.0,
) -> DataFrame:
    """Replace column ``prompt`` by ``output``, the ``answer`` to it.

    ``tasks`` calls run side by side (by default as many as ``df`` has partitions). ``pause_seconds``
    is the pace of all tasks together: with n tasks, each waits n times as long between its calls.
    With ``answers``, equal prompts and repeated tasks call once; the calls of one prompt that run at
    the same moment do not know of each other.
    """
    if tasks is not None:
        df = df.repartition(tasks)
    elif pause_seconds:
        tasks = df.rdd.getNumPartitions()
    wait = pause_seconds * (tasks or 1)
    kept = [f for f in df.schema.fields if f.name != prompt]
    schema = T.StructType([*kept, T.StructField(output, T.StringType())])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [
                answer(text, generate, fallback, wait, answers, attempts, backoff_seconds) for text in frame[prompt]
            ]
            yield frame.drop(columns=prompt).assign(**{output: texts})

    return df.mapInPandas(batches, schema)
