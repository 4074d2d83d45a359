"""Tables in and out, and saved models."""

from rainpanel.sources.models import (
    load_coefficients, load_model, model_path, save_coefficients, save_model,
)
from rainpanel.sources.tables import (
    from_rows, read_csv, read_csv_by_name, read_csv_inferred, read_parquet, settled, split_bad_rows,
    use_checkpoint_folder, write_csv, write_parquet,
)

__all__ = [
    "from_rows", "load_coefficients", "load_model", "model_path", "read_csv", "read_csv_by_name",
    "read_csv_inferred", "read_parquet", "save_coefficients", "save_model", "settled", "split_bad_rows",
    "use_checkpoint_folder", "write_csv", "write_parquet",
]
