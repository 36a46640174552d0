from .files import (lowercase_names, read_fact_source, read_header_csv, read_partitioned, refresh_partitions,
                    write_header_csv, write_partitioned)
from .labels import label_sections, label_table, parse_label_section, read_label_lines, write_label_file

__all__ = ["lowercase_names", "read_fact_source", "read_header_csv", "read_partitioned", "refresh_partitions",
           "write_header_csv", "write_partitioned", "label_sections", "label_table", "parse_label_section",
           "read_label_lines", "write_label_file"]
