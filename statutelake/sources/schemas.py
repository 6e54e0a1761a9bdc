"""Declared schemas of the source documents; nothing is inferred."""

from __future__ import annotations

ARTICLE = "struct<title:string,content:string,order_index:int,global_order:int>"
SECTION = f"struct<title:string,order_index:int,global_order:int,articles:array<{ARTICLE}>>"
CHAPTER = f"struct<title:string,order_index:int,global_order:int,sections:array<{SECTION}>,articles:array<{ARTICLE}>>"
PART = f"struct<title:string,order_index:int,global_order:int,chapters:array<{CHAPTER}>>"

STATUTE = (
    "law_id bigint, title string, category string, legal_domain string, subject_area string, pub_date string, effective_date string, "
    "promulgation_info string, issuing_org string, doc_number string, total_articles int, full_text string, is_current int, repealed_by string, "
    f"parts array<{PART}>, chapters array<{CHAPTER}>, _corrupt_record string"
)
GAZETTE = (
    "title string, issue string, url string, doc_number string, pub_date string, effective_date string, content string, year int, issue_num int, "
    "doc_key string, case_number string, ruling_gist string, keywords string, keywords_meta map<string,array<string>>, law_id bigint, repealed_by string, "
    "is_current int, _corrupt_record string"
)
TRANSLATION = (
    "law_id bigint, title_en string, promulgation_info_en string, "
    "articles array<struct<article_number:string,content_en:string>>, _corrupt_record string"
)
GAZETTE_TRANSLATION = "doc_key string, title_en string, ruling_gist_en string, keywords_en string, full_text_en string, _corrupt_record string"
CATALOG = "title string, pub_date string, effective_date string, category string"
