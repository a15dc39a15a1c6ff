"""Feature building and forecasting over panels of many time series, on Spark."""

from seriesloom.spec import PanelSpec

__all__ = ["PanelSpec"]
