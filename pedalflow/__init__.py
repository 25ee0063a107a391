"""pedalflow: bike-share trip analytics as Spark DataFrame plans."""

from .plans.data import TripData
from .session import ensure_checkpoint_dir, local_session

__all__ = ["TripData", "ensure_checkpoint_dir", "local_session"]
