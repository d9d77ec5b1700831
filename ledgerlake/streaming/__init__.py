from .incremental_landing import start_incremental_landing

__all__ = ["start_incremental_landing"]
