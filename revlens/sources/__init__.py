from revlens.sources.io import (read_json, read_parquet, read_csv_strings, strip_header,
                                write_table, write_csv, write_small_csv, save_model,
                                load_model, persist_cut)

__all__ = ["read_json", "read_parquet", "read_csv_strings", "strip_header",
           "write_table", "write_csv", "write_small_csv", "save_model", "load_model",
           "persist_cut"]
