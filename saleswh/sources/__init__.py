from saleswh.sources.dumps import read_copy_text, read_dump
from saleswh.sources.readers import (
    MISSING_TOKENS,
    dataset_size_mb,
    inline_rows,
    read_csv_inferred,
    read_products,
    read_sales_csv,
    read_scaled,
    read_table,
    read_typed_csv,
    storage_footprint,
    table_options,
)
from saleswh.sources.writers import (
    append_jdbc,
    append_table,
    create_view,
    ctas,
    drop_view,
    latest_path,
    prepare,
    prescale,
    publish_version,
    read_latest,
    scaled_path,
    write_once,
    write_report,
)

__all__ = [
    "MISSING_TOKENS", "append_jdbc", "append_table", "create_view", "ctas", "dataset_size_mb", "drop_view", "inline_rows", "latest_path",
    "prepare", "prescale", "publish_version", "read_copy_text", "read_csv_inferred", "read_dump", "read_latest", "read_products",
    "read_sales_csv", "read_scaled", "read_table", "read_typed_csv", "scaled_path", "storage_footprint", "table_options", "write_once", "write_report",
]
