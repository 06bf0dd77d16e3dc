"""Schemas of the pipeline's entities, as DDL that every reader takes. Absent keys read as null."""

from __future__ import annotations

CREATOR = "struct<name:string,name_type:string,identifiers:array<string>,affiliations:array<string>>"
RIGHT = "struct<rights:string,rights_uri:string,rights_identifier:string,scheme_uri:string>"
IDENTIFIER = "struct<identifier:string,identifier_type:string>"
CITATION_BLOCK = "struct<dois:array<string>,other:array<struct<id:string,type:string>>>"

SLIM = (
    f"source string, identifiers array<{IDENTIFIER}>, url string, title string, subjects array<string>, description string, version string, publisher string, "
    f"publisher_id string, rights array<{RIGHT}>, doi_created_date string, issued string, created string, published string, publication_year int, pubyear int, "
    f"publication_date string, creators array<{CREATOR}>, citations {CITATION_BLOCK}"
)
RAW_DATACITE = (
    "id string, type string, attributes struct<doi:string,url:string,version:string,publisher:string,created:string,published:string,publicationYear:int,"
    "titles:array<struct<title:string,lang:string,titleType:string>>,subjects:array<struct<subject:string,schemeUri:string,subjectScheme:string>>,"
    "descriptions:array<struct<description:string,descriptionType:string>>,dates:array<struct<date:string,dateType:string>>,"
    "rightsList:array<struct<rights:string,rightsUri:string,rightsIdentifier:string,schemeUri:string>>,"
    "creators:array<struct<name:string,nameType:string,affiliation:string,nameIdentifiers:array<struct<nameIdentifier:string,nameIdentifierScheme:string>>>>>,"
    "relationships struct<client:struct<data:struct<id:string>>,citations:struct<data:array<struct<id:string,type:string>>>>"
)
METADATA = f"dataset_id string, pub_ts string, pubyear int, creators array<{CREATOR}>, title string, source string, publisher string"
MY_DATASETS = "dataset_id string, id_type string, pubyear int, added_date timestamp_ntz"
_EVIDENCE = "dataset_id string, source array<string>, {0}_link string, {0}_weight double, {0}_date string, placeholder_date boolean, {0}_year int, placeholder_year boolean"
CITATION, MENTION = _EVIDENCE.format("citation"), _EVIDENCE.format("mention")
FAIR = "dataset_id string, score double, evaluationDate string, metricVersion string, softwareVersion string"
TOPIC = (
    "dataset_id string, topic_id string, topic_name string, score double, source string, subfield_id string, subfield_name string, field_id string, field_name string, "
    "domain_id string, domain_name string"
)
MODEL_TOPIC = (
    "dataset_id string, topic struct<id:string,name:string,score:double>, subfield struct<id:string,name:string>, field struct<id:string,name:string>, domain struct<id:string,name:string>"
)
OA_WORK = "id string, doi string, publication_date string, publication_year int, primary_topic struct<id:string,display_name:string,score:double>, referenced_works array<string>"
MDC_RECORD = "id string, created string, updated string, title string, source string, dataset string, publication string, publishedDate string"
HF_SCAN = "model_id string, url string, created_at string, references array<struct<type:string,id:string,source:string,hf_dataset_id:string>>"
SWH_MENTION = "dataset_id string, mention_link string, mention_date string, source string"
PATENT = "patent_id string, mention_link string, mention_date string, doi array<string>, emdb_id array<string>, source_file string"
LEDGER = "source string, day date, records int, inserted int, skipped int, failed int, indexed boolean"
EMDB_RECORD = (
    "emdb_id string, title string, deposition_date string, update_date string, keywords string, "
    "authors array<struct<valueOf_:string,ORCID:string>>, primary_citation struct<doi:string,title:string,authors:array<struct<valueOf_:string,ORCID:string>>>, related_dois array<string>"
)
