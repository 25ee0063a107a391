from .data import TripData

__all__ = ["TripData"]
