from riskframe.streaming.monthly import monthly_volume_stream, run_available

__all__ = ["monthly_volume_stream", "run_available"]
