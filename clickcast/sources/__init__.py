from clickcast.sources.read import clicks, read_clicks_checked, read_clicks_csv, read_parquet
from clickcast.sources.write import write_clicks_csv, write_metric, write_parquet, write_predictions_csv

__all__ = [
    "clicks",
    "read_clicks_checked",
    "read_clicks_csv",
    "read_parquet",
    "write_clicks_csv",
    "write_metric",
    "write_parquet",
    "write_predictions_csv",
]
