"""A slot for sequence models: residues to structure letters, back, and embeddings.

A Translator is built once per Python worker by its factory and handed batches. No model is part of
this package; `Letters` is a stand-in for tests that maps letters by a fixed rule and says so."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from helixframe.schemas import ALPHABET


class Translator(Protocol):
    def translate(self, seqs: list[str]) -> list[str]: ...

    def embed(self, seqs: list[str]) -> list[list[list[float]]]: ...


class Letters:
    """Not a model: the alphabet turned by a number of places."""

    def __init__(self, turn: int = 1):
        self.map = {c: ALPHABET[(i + turn) % len(ALPHABET)] for i, c in enumerate(ALPHABET)}

    def translate(self, seqs: list[str]) -> list[str]:
        return ["".join(self.map.get(c, "D") for c in s.upper()) for s in seqs]

    def embed(self, seqs: list[str]) -> list[list[list[float]]]:
        return [[[float(ALPHABET.find(c)), 1.0] for c in s.upper()] for s in seqs]


def _cut(seq: str, longest: int | None) -> list[str]:
    return [seq] if longest is None or len(seq) <= longest else [seq[i : i + longest] for i in range(0, len(seq), longest)]


def translate(seqs: DataFrame, factory: Callable[[], Translator], longest: int | None = None) -> DataFrame:
    """(seq_id, seq) with seq translated; longer sequences are cut to bound a model's memory and
    joined again. Each sequence is translated in the task that holds it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            parts = [_cut(s or "", longest) for s in frame["seq"]]
            done = iter(model.translate([p for own in parts for p in own]))
            yield pd.DataFrame({"seq_id": frame["seq_id"], "seq": ["".join(next(done) for _ in own) for own in parts]})

    return seqs.select("seq_id", "seq").mapInPandas(run, "seq_id string, seq string")


def embed(seqs: DataFrame, factory: Callable[[], Translator]) -> DataFrame:
    """(seq_id, resi, embedding): one row per residue."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            for seq_id, rows in zip(frame["seq_id"], model.embed(frame["seq"].tolist()), strict=True):
                if rows:
                    yield pd.DataFrame({"seq_id": seq_id, "resi": range(len(rows)), "embedding": rows})

    return seqs.select("seq_id", "seq").mapInPandas(run, "seq_id string, resi int, embedding array<double>")


def external(seqs: DataFrame, command: list[str], timeout: float = 3600.0) -> DataFrame:
    """(seq_id, seq) from a program that reads FASTA and writes FASTA: one run per batch, on the
    executor that holds it. A failed run fails its task, which Spark repeats elsewhere."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            given = "".join(f">{i}\n{s or ''}\n" for i, s in zip(frame["seq_id"], frame["seq"], strict=True))
            out = subprocess.run(command, input=given, capture_output=True, text=True, timeout=timeout, check=True).stdout
            records = [r.split("\n", 1) for r in ("\n" + out).split("\n>")[1:]]
            yield pd.DataFrame({"seq_id": [r[0].split()[0] for r in records], "seq": ["".join(r[1].split()) if len(r) > 1 else "" for r in records]}, dtype=object)

    return seqs.select("seq_id", "seq").mapInPandas(run, "seq_id string, seq string")
