from tablewright.streaming.micro_batch import run_available, stream_into_table

__all__ = ["run_available", "stream_into_table"]
