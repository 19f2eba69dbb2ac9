"""STR-01: pages that are complete, as their items arrive in any order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leafmill.session import ship

OUT = "doc_id long, page long, complete boolean, n_items long"
STATE = "done array<string>, told boolean"
#: How long a page is remembered after its last item, in milliseconds.
KEEP_MS = 24 * 3600 * 1000


def completions(items: DataFrame, keep_ms: int = KEEP_MS) -> DataFrame:
    """items (doc_id, page, item, expected, ok): each page once, when its last item is in. An
    item that failed for now leaves the page incomplete; a later one that is ok makes up for
    it. Items go by their name, so one that is delivered again counts once. A page's state goes
    when nothing has come for it for so long; one that comes back later begins anew. A run that is
    to end once its input is used up needs spark.sql.streaming.noDataMicroBatches.enabled off, or
    it waits for pages to time out."""
    ship(items.sparkSession)

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before, told = state.get if state.exists else ([], False)
        done, expected = set(before or ()), 0
        for f in frames:
            done |= set(f.loc[f["ok"].astype(bool), "item"].astype(str))
            expected = max(expected, int(f["expected"].max()))
        now = not told and len(done) >= expected
        told = told or now
        state.update(([] if told else sorted(done), told))
        state.setTimeoutDuration(keep_ms)
        if now:
            yield pd.DataFrame({"doc_id": [key[0]], "page": [key[1]], "complete": [True], "n_items": [len(done)]})

    return items.groupBy("doc_id", "page").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
