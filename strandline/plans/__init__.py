"""The jobs, put together from the operators."""

from strandline.plans.backfill import backfill
from strandline.plans.health import check_files, setup_checks
from strandline.plans.incremental import incremental
from strandline.plans.ingest import fan_out, fan_out_one_stream, ingest, read_fan_out
from strandline.plans.silver import silver_schema, silver_view

__all__ = [
    "backfill",
    "check_files",
    "fan_out",
    "fan_out_one_stream",
    "incremental",
    "ingest",
    "read_fan_out",
    "setup_checks",
    "silver_schema",
    "silver_view",
]
