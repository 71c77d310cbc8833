"""Keyed streams of decoded tokens: state per stream, utterances closed at gaps or at the end of the stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INPUT = "stream_id string, frame_no int, tokens array<int>, timesteps array<double>, is_last boolean"
OUTPUT = "stream_id string, utterance int, kind string, tokens array<int>, start double, end double"
_STATE = "tokens array<int>, timesteps array<double>, utterance int"


def longest_overlap(old: list[int], new: list[int], limit: int) -> int:
    """The longest end of old, up to limit, with which new begins."""
    return max((k for k in range(1, min(len(old), len(new), limit) + 1) if old[-k:] == new[:k]), default=0)


class Utterances(StatefulProcessor):
    """Per stream: new tokens are appended without what overlaps the old ones in tokens and in time; a gap above silence
    closes the utterance before it, the last frame the whole, and the stream's state goes.

    Rows of a stream in one batch are taken in the order of their frames.
    """

    def __init__(self, silence: float = 20.0, limit: int = 3, close: float = 2.0, partials: bool = False):
        self.silence, self.limit, self.close_steps, self.partials = silence, limit, close, partials

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:  # noqa: N802
        tokens, steps, n = [], [], 0
        if self.state.exists():
            got = self.state.get()
            tokens, steps, n = list(got[0]), list(got[1]), int(got[2])
        pdf = pd.concat(list(rows)).sort_values("frame_no", kind="stable")
        out: list[tuple] = []
        ended = False
        for r in pdf.itertuples(index=False):
            new, at = [int(x) for x in r.tokens], [float(x) for x in r.timesteps]
            k = longest_overlap(tokens, new, self.limit) if tokens else 0
            if k and at[k - 1] - steps[-k] > self.close_steps:
                k = 0
            for t, s in zip(new[k:], at[k:], strict=True):
                if steps and s - steps[-1] - 1 > self.silence:
                    out.append((key[0], n, "final", tokens, steps[0], steps[-1]))
                    tokens, steps, n = [], [], n + 1
                tokens, steps = [*tokens, t], [*steps, s]
            if self.partials and tokens and not r.is_last:
                out.append((key[0], n, "partial", tokens, steps[0], steps[-1]))
            if r.is_last:
                if tokens:
                    out.append((key[0], n, "final", tokens, steps[0], steps[-1]))
                tokens, steps, n, ended = [], [], n + 1, True
        if ended and not tokens:
            self.state.clear()
        else:
            self.state.update((tokens, steps, n))
        yield pd.DataFrame(out, columns=["stream_id", "utterance", "kind", "tokens", "start", "end"])

    def close(self) -> None:
        pass


def utterances(frames: DataFrame, **settings: Any) -> DataFrame:
    """Utterances of a streaming (or static) table of frames with the columns of INPUT."""
    frames.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return frames.groupBy("stream_id").transformWithStateInPandas(statefulProcessor=Utterances(**settings), outputStructType=OUTPUT, outputMode="Append", timeMode="None")


def drain(df: DataFrame, folder: str, mode: str = "append", sink: Callable[[DataFrame], None] | None = None) -> None:
    """Run a streaming table over what is there now and write it to folder as parquet; every batch once.

    In complete mode each batch replaces the table; in append mode a batch has a folder of its own, so that a batch which
    is run again after a failure replaces itself.
    """

    def put(batch: DataFrame, number: int) -> None:
        if sink:
            sink(batch)
        elif mode == "complete":
            batch.write.mode("overwrite").parquet(f"{folder}/data")
        else:
            batch.write.mode("overwrite").parquet(f"{folder}/data/batch={number}")

    query = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
