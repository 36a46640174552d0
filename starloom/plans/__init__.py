from .fact import i94_fact
from .star import StarInputs, build_dimensions, build_star, refresh_fact_month, star_quality, star_summary

__all__ = ["i94_fact", "StarInputs", "build_dimensions", "build_star", "refresh_fact_month", "star_quality",
           "star_summary"]
