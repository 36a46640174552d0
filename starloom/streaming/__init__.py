from .refresh import run_monthly_refresh

__all__ = ["run_monthly_refresh"]
