"""Calls of outside scorers that are made once: bounded in number at a time, tried again when it may help, and landed by key.

An outcome is a small file in a shared folder, named after the request's key, written as soon as it is known. A task that runs
again, a plan that is evaluated twice and a later run over the same folder find it there and don't call.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Asks one scorer about one request, the columns of a row by name; None stands for no answer.
Ask = Callable[[dict], object]


@dataclass(frozen=True)
class Landing:
    """Where outcomes land (a folder that driver and executors share, as a URI), how many calls run at once, and how often one is tried.

    Between two tries of a call pass wait[0] seconds at least and wait[1] at most, twice as many each time. Only errors of the kinds in
    transient are tried again; others, and the last of them, are the outcome.
    """

    folder: str
    calls: int = 5
    attempts: int = 3
    wait: tuple[float, float] = (2.0, 10.0)
    transient: tuple[type[BaseException], ...] = (ConnectionError, TimeoutError)
    pause: Callable[[float], None] = time.sleep


def call(ask: Ask, request: dict, landing: Landing) -> dict:
    """The outcome of one request: answer, error and the number of tries."""
    for n in range(1, landing.attempts + 1):
        try:
            answer = ask(request)
            return {"answer": None if answer is None else str(answer), "error": None, "tries": n}
        except landing.transient as e:
            error = f"{type(e).__name__}: {e}"
            if n < landing.attempts:
                landing.pause(min(landing.wait[1], max(landing.wait[0], 2.0 ** (n - 1))))
        except Exception as e:  # whatever else a scorer raises is its outcome
            return {"answer": None, "error": f"{type(e).__name__}: {e}", "tries": n}
    return {"answer": None, "error": error, "tries": landing.attempts}


class Journal:
    """Outcomes of one kind of request below a folder."""

    def __init__(self, folder: str, kind: str):
        from pyarrow import fs

        self.fs, path = fs.FileSystem.from_uri(folder)
        self.path = f"{path}/{kind}"
        self.missing = fs.FileType.NotFound

    def place(self, key: object) -> str:
        name = hashlib.sha256(repr(key).encode()).hexdigest()
        return f"{self.path}/{name[:2]}/{name}"

    def read(self, key: object) -> dict | None:
        place = self.place(key)
        if self.fs.get_file_info(place).type == self.missing:
            return None
        with self.fs.open_input_stream(place) as f:
            return json.loads(f.read())

    def write(self, key: object, outcome: dict) -> None:
        """The whole file or none: it gets its name once it is complete."""
        place = self.place(key)
        self.fs.create_dir(place.rpartition("/")[0], recursive=True)
        part = f"{place}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(outcome).encode())
        self.fs.move(part, place)


def landed(requests: DataFrame, key: str, ask: Ask, landing: Landing, kind: str) -> DataFrame:
    """(key, answer, error, tries) for each key of requests; lazy, and evaluated as often as one likes.

    Requests are dealt by key to as many tasks as calls may run at once, and a task makes one call at a time. A key that stands
    twice is asked once, about whichever of its rows comes first. Outcomes of different kinds don't meet. A task that dies between an answer and its file
    asks that one request again. Speculative copies of a task may call side by side, so leave speculation off.
    """
    names = requests.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        journal, done = Journal(landing.folder, kind), set()
        for b in batches:
            out = []
            for row in b.itertuples(index=False, name=None):
                request = {c: None if v is None or v is pd.NA or v != v else v for c, v in zip(names, row)}
                k = request[key]
                if k in done:
                    continue
                done.add(k)
                outcome = journal.read(k)
                if outcome is None:
                    outcome = call(ask, request, landing)
                    journal.write(k, outcome)
                out.append((k, outcome["answer"], outcome["error"], outcome["tries"]))
            yield pd.DataFrame(out, columns=[key, "answer", "error", "tries"])

    kind_of_key = requests.schema[key].dataType.simpleString()
    return requests.repartition(landing.calls, F.col(key)).mapInPandas(run, f"`{key}` {kind_of_key}, answer string, error string, tries int")
