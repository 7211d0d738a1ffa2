"""Readers and sinks."""

from riskloom.sources.io import (  # noqa: F401
    export_report,
    load,
    normalise_missing,
    preview,
    save,
    snake_case,
    split_features_target,
    to_markdown_lines,
)
