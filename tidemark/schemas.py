"""Schemas of the landing tables and of the reject report."""

from __future__ import annotations

DATA_FIELDS = ("name", "identifiers", "ecosystem_type", "location", "latitude", "longitude", "date", "sub_location", "additional_details", "attribute", "value", "units")

PAPERS = (
    "id bigint, doi string, openalex_id string, semantic_scholar_id string, title string, abstract string, discovered_from string, oa_pdf_url string, "
    "authors array<string>, publication_date date, metadata string, status string, discovered_at timestamp, extracted_at timestamp, filter_confidence float, error string"
)
EXTRACTIONS = (
    "id bigint, paper_id bigint, schema_name string, model_version string, data struct<name: string, identifiers: string, ecosystem_type: string, location: string, latitude: double, "
    "longitude: double, date: string, sub_location: string, additional_details: string, attribute: string, value: string, units: string>, confidence float, provenance string, latitude double, "
    "longitude double, page_number int, page_matched boolean, judgement string, created_at timestamp"
)
OCR_CONTEXT = ("paper_id bigint, context string, created_at timestamp")
VOTES = ("id bigint, extraction_id bigint, vote boolean, voter_hash string, created_at timestamp")
CRAWL_STATE = ("source string, watermark date, updated_at timestamp")
#: What a feed delivers for a paper, before it has an id.
LANDING = (
    "doi string, openalex_id string, semantic_scholar_id string, title string, abstract string, discovered_from string, oa_pdf_url string, authors array<string>, publication_date date, metadata string"
)
REJECTS = ("extraction_id bigint, paper_id bigint, reason string, detail string")
