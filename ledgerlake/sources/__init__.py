from .adapter import DriverRaw, adapter_sql, read_driver, DRIVER_TABLES

__all__ = ["DriverRaw", "adapter_sql", "read_driver", "DRIVER_TABLES"]
