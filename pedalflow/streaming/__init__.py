from .ingest import landed, landed_quarantine, landed_trips, start_landing, trip_stream

__all__ = ["landed", "landed_quarantine", "landed_trips", "start_landing", "trip_stream"]
