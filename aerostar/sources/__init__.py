"""Scans: typed CSV, nested hotel lookup JSON, saved web pages."""

from aerostar.sources.csv import (
    quarantine_csv, read_hotels, read_legs, read_quarantine, read_rejects, read_typed_csv, split_records,
)
from aerostar.sources.hotel_json import flatten_hotel_pages, parse_hotel_pages, reject_hotel_pages, tag_hotel_pages
from aerostar.sources.web_pages import (
    Element, decode_entities, element_text, elements_text, extract_page_fields, attribute, attributes, unequal_lists,
    zip_fields,
)

__all__ = ["read_legs", "read_hotels", "read_typed_csv", "read_rejects", "parse_hotel_pages",
           "reject_hotel_pages", "flatten_hotel_pages", "extract_page_fields", "zip_fields",
           "unequal_lists", "element_text", "elements_text", "attribute", "attributes",
           "decode_entities", "Element", "quarantine_csv", "read_quarantine", "split_records", "tag_hotel_pages"]
