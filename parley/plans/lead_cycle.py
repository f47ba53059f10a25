"""One turn of the lead cycle: dispatch, results, training trigger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.keys import run_id
from parley.operators.leads import inference_payloads, mark_queued, pending_leads, trigger_gate
from parley.operators.runs import training_run
from parley.schemas import LEADS_PER_DISPATCH, TRIGGER_THRESHOLD


def next_dispatch(leads: DataFrame, n: int = LEADS_PER_DISPATCH, seed: str | int = 42) -> DataFrame:
    """Payloads of the next pending leads; those without a conversation are passed over."""
    return inference_payloads(pending_leads(leads, n), seed=seed)


def trigger_training(
    leads: DataFrame, at: Column, execution_id: Column | None = None, threshold: int = TRIGGER_THRESHOLD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gate row, leads tagged when the gate is met, ledger row of the run."""
    gate = trigger_gate(leads, threshold)
    run = run_id(at)
    met = gate.select(F.col("status") == "triggered").scalar()
    ledger = training_run(gate, run, F.lit(None) if execution_id is None else execution_id, at)
    return gate, mark_queued(leads, run, at, when=met), ledger
