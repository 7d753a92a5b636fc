"""Balance continuity over a stream: an account's last balance is its state. Rows of an account are checked in the
order of time and row inside a micro-batch, and batches in the order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallybrook.schema import TOLERANCE

OUT = "own_account string, txn_id string, diff double"


def _breaks(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    seen, before = state.get if state.exists else (False, None)
    rows = pd.concat(parts).sort_values(["txn_time", "source_row"], kind="stable", na_position="last")
    found = []
    for txn, income, expense, balance in zip(rows["txn_id"], rows["income"].fillna(0.0), rows["expense"].fillna(0.0), rows["balance"]):
        now = None if pd.isna(balance) else float(balance)
        if seen and before is not None and now is not None and abs(now - (before + income - expense)) >= TOLERANCE:
            found.append((key[0], txn, abs(now - (before + income - expense))))
        seen, before = True, now
    state.update((seen, before))
    yield pd.DataFrame(found, columns=["own_account", "txn_id", "diff"])


def balance_breaks(stream: DataFrame) -> DataFrame:
    """own_account, txn_id, diff of every break, as it comes."""
    rows = stream.select(F.coalesce("own_account", F.lit("")).alias("own_account"), "txn_id", "txn_time", "source_row", "income", "expense", "balance")
    return rows.groupBy("own_account").applyInPandasWithState(_breaks, OUT, "seen boolean, balance double", "append", GroupStateTimeout.NoTimeout)
