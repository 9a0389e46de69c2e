"""Reusable DataFrame operators."""
from tallystar.operators.dedupe import one_row_per_key
from tallystar.operators.ranking import dense_ranks
from tallystar.operators.totals import with_totals
from tallystar.operators.workspace import (
    Workspace,
    release_exchanges,
    remove_run_folder,
    run_folder,
    run_workspace,
    scratch_folder,
)

__all__ = [
    "Workspace", "dense_ranks", "one_row_per_key", "release_exchanges", "remove_run_folder",
    "run_folder", "run_workspace", "scratch_folder", "with_totals",
]
