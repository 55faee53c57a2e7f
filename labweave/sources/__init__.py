"""Readers for report files and configuration folders."""

from labweave.sources.config import Dims, clinics_from_files, dims_from_folder, make_dims, small
from labweave.sources.files import parse_documents, read_files, split_path

__all__ = [
    "Dims", "clinics_from_files", "dims_from_folder", "make_dims", "parse_documents",
    "read_files", "small", "split_path",
]
