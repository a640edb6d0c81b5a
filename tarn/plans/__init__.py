"""The layer jobs and their configuration."""

from tarn.plans.layers import LayerRun, run_all, run_bronze, run_gold, run_silver
from tarn.plans.settings import scale_settings

__all__ = [
    "LayerRun",
    "run_all",
    "run_bronze",
    "run_gold",
    "run_silver",
    "scale_settings",
]
