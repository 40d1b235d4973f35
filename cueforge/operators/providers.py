"""Models outside Spark: speech and text providers, called once a partition's batches come by.

A provider is built in the worker by a factory, so a model is loaded once a worker and nothing is pickled but the factory.
Tests and repeatable runs use recorded tables instead (see plans.pipelines).
"""

from __future__ import annotations

import json
import subprocess
import tempfile
import time
import urllib.request
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

#: Model sizes that transcribe takes; a provider maps them to its own names.
MODELS = ("tiny", "base", "small", "medium", "large", "turbo")


class Transcriber(Protocol):
    def segments(self, path: str) -> list[dict]:
        """start and end in seconds, and text, of a whole medium."""

    def clip(self, path: str, start_ms: int, end_ms: int, hint: str) -> str:
        """Text of a part of a medium."""


class Corrector(Protocol):
    def complete(self, messages: list[dict]) -> str:
        """A reply to chat messages; raises on failure."""


def clip_command(path: str, start_ms: int, end_ms: int, out: str) -> list[str]:
    """Arguments that cut a part out as 16 kHz mono WAVE. A list, never a shell line."""
    return ["ffmpeg", "-y", "-ss", f"{start_ms / 1000:.3f}", "-i", path, "-t", f"{(end_ms - start_ms) / 1000:.3f}", "-vn", "-ar", "16000", "-ac", "1", "-f", "wav", out, "-loglevel", "error"]


def extract_clip(path: str, start_ms: int, end_ms: int, out: str) -> None:
    subprocess.run(clip_command(path, start_ms, end_ms, out), check=False)


class ClipTranscriber:
    """Makes a Transcriber of a function from a WAVE file and a hint to text, and one from a medium to segments."""

    def __init__(self, transcribe: Callable[[str, str], str], whole: Callable[[str], list[dict]] | None = None, extract=extract_clip):
        self.transcribe, self.whole, self.extract = transcribe, whole, extract

    def segments(self, path: str) -> list[dict]:
        if self.whole is None:
            raise NotImplementedError("no function for whole media")
        return self.whole(path)

    def clip(self, path: str, start_ms: int, end_ms: int, hint: str) -> str:
        with tempfile.TemporaryDirectory() as d:  # the worker's own, gone with the call
            out = str(Path(d, "clip.wav"))
            self.extract(path, start_ms, end_ms, out)
            return self.transcribe(out, hint).strip()


class HttpCorrector:
    """Chat completions over HTTP. The key is an argument: nothing reads the environment."""

    def __init__(self, url: str, model: str, api_key: str, max_tokens: int = 300, temperature: float = 0.0, timeout: float = 30.0, delay: float = 0.3):
        if not api_key:
            raise ValueError("an API key is needed")
        self.url, self.key, self.timeout, self.delay = url, api_key, timeout, delay
        self.fixed = {"model": model, "max_tokens": max_tokens, "temperature": temperature}
        self.called = False

    def complete(self, messages: list[dict]) -> str:
        if self.called and self.delay > 0:
            time.sleep(self.delay)  # between calls, not after the last
        self.called = True
        request = urllib.request.Request(self.url, json.dumps(self.fixed | {"messages": messages}).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.load(reply)["choices"][0]["message"]["content"].strip()


def with_replies(df: DataFrame, factory: Callable[[], Corrector], calls_at_once: int | None = None) -> DataFrame:
    """file_id, ordinal, raw, error: the reply to each row's messages, or why there is none.

    calls_at_once bounds the partitions, and with them the calls that run at the same time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for batch in batches:
            rows = []
            for file_id, ordinal, messages in zip(batch["file_id"], batch["ordinal"], batch["messages"], strict=True):
                try:
                    rows.append((file_id, ordinal, provider.complete([dict(m) if isinstance(m, dict) else m.asDict() for m in messages]), None))
                except Exception as e:
                    rows.append((file_id, ordinal, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["file_id", "ordinal", "raw", "error"])

    own = df.select("file_id", "ordinal", "messages")
    return (own.coalesce(calls_at_once) if calls_at_once else own).mapInPandas(run, "file_id string, ordinal int, raw string, error string")


def with_clips(df: DataFrame, factory: Callable[[], Transcriber]) -> DataFrame:
    """file_id, ordinal, whisper: each row (media, start_ms, end_ms, hint, noisy) heard again; noisy where that fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                try:
                    out.append((r.file_id, r.ordinal, provider.clip(r.media, r.start_ms, r.end_ms, r.hint)))
                except Exception:
                    out.append((r.file_id, r.ordinal, r.noisy))
            yield pd.DataFrame(out, columns=["file_id", "ordinal", "whisper"])

    return df.select("file_id", "ordinal", "media", "start_ms", "end_ms", "hint", "noisy").mapInPandas(run, "file_id string, ordinal int, whisper string")


def segments(media: DataFrame, factory: Callable[[str], Transcriber], model: str = "medium") -> DataFrame:
    """file_id, ordinal, start, end (seconds), text of every medium (file_id, media). An unknown model is an error."""
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; one of {', '.join(MODELS)}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory(model)
        for batch in batches:
            for file_id, path in zip(batch["file_id"], batch["media"], strict=True):
                own = provider.segments(path)
                yield pd.DataFrame([(file_id, k, float(s["start"]), float(s["end"]), s["text"]) for k, s in enumerate(own, 1)], columns=["file_id", "ordinal", "start", "end", "text"])

    return media.select("file_id", "media").mapInPandas(run, "file_id string, ordinal int, start double, end double, text string")
