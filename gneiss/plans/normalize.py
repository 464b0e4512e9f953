"""Clean tables from raw records: one builder for each source, all native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions import address, names
from gneiss.functions.convert import blank_to_null, coordinates, integer, local_timestamp, number
from gneiss.operators.quality import fill_rates
from gneiss.operators.versions import dup_rank, first_by, latest_versions


def _items(raw: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    rows = latest_versions(raw, "source_record_id", "updated_at", "ingested_at", "payload")
    return rows.withColumn("p", F.from_json("payload", "map<string,string>")), lambda k: F.try_element_at("p", F.lit(k))


def _with(rows: DataFrame, addr: Column, **columns: Column) -> DataFrame:
    out = rows.select(F.col("source_record_id"), addr.alias("_a"), *[c.alias(k) for k, c in columns.items()])
    return out.select("*", "_a.*").drop("_a")


def complaints(raw: DataFrame) -> DataFrame:
    rows, f = _items(raw)
    lat, lon = coordinates(f("latitude"), f("longitude"))
    plain = ("status", "agency", "complaint_type", "descriptor", "location_type", "community_board")
    return _with(
        rows, address.from_free_text(f("incident_address"), f("borough"), f("incident_zip")), complaint_id=f("unique_key"), created_date=local_timestamp(f("created_date")),
        closed_date=local_timestamp(f("closed_date")), **{k: f(k) for k in plain}, channel=f("open_data_channel_type"), bbl=address.lot(f("bbl")), latitude=lat, longitude=lon,
    )


def permits(raw: DataFrame) -> DataFrame:
    rows, f = _items(raw)
    lat, lon = coordinates(f("latitude"), f("longitude"))
    business, person = names.name(f("owner_business_name")), names.last_first(f("owner_name"))
    out = _with(
        rows, address.from_parts(f("house_no"), f("street_name"), f("borough"), f("zip_code")), permit_row_id=F.col("source_record_id"),
        **{k: blank_to_null(f(k)) for k in ("job_filing_number", "work_permit", "sequence_number", "bin")}, **{k: f(k) for k in ("permit_status", "filing_reason", "work_type", "job_description")},
        estimated_job_cost=number(f("estimated_job_costs")), **{k: local_timestamp(f(k)) for k in ("issued_date", "approved_date", "expired_date")},
        bbl=F.coalesce(address.lot(f("bbl")), address.lot_from_parts(f("borough"), f("block"), f("lot"))), owner_name=F.coalesce(business, person),
        owner_is_org=names.is_organisation(F.coalesce(F.nullif(f("owner_business_name"), F.lit("")), f("owner_name"))), owner_business_name=business, owner_person_name=person,
        applicant_business_name=names.name(f("applicant_business_name")), applicant_person_name=names.person(f("applicant_first_name"), f("applicant_last_name")), latitude=lat, longitude=lon,
    )
    return dup_rank(out, ["job_filing_number", "work_permit", "sequence_number", "issued_date"], ["permit_row_id"])


def licences(raw: DataFrame) -> DataFrame:
    rows, f = _items(raw)
    lat, lon = coordinates(f("latitude"), f("longitude"))
    return _with(
        rows, address.from_parts(f("address_building"), f("address_street_name"), f("address_borough"), f("address_zip")), license_id=F.col("source_record_id"),
        **{k: f(k) for k in ("business_unique_id", "business_category", "license_type", "license_status")}, business_name=names.name(f("business_name")),
        dba_trade_name=names.name(f("dba_trade_name")), license_created=local_timestamp(f("license_creation_date")), license_expires=local_timestamp(f("lic_expir_dd")),
        contact_phone=names.phone(f("contact_phone")), address_city=F.upper(blank_to_null(f("address_city"))), address_state=F.upper(blank_to_null(f("address_state"))),
        is_nyc_premises=address.borough(f("address_borough")).isNotNull(), bin=blank_to_null(f("bin")), bbl=address.lot(f("bbl")), latitude=lat, longitude=lon,
    )


def lots(raw: DataFrame) -> DataFrame:
    """One row for each lot number, of several records the smallest id's; records without a valid number are left out."""
    rows, f = _items(raw)
    lat, lon = coordinates(f("latitude"), f("longitude"))
    out = _with(
        rows, address.from_free_text(f("address"), f("borough"), f("zipcode")), bbl=address.lot(f("bbl")), units_res=integer(f("unitsres")), units_total=integer(f("unitstotal")),
        owner_name=names.last_first(f("ownername")), owner_is_org=names.is_organisation(f("ownername")), year_built=integer(f("yearbuilt")), bldg_class=f("bldgclass"), latitude=lat, longitude=lon,
    )
    return first_by(out.where("bbl is not null"), ["bbl"], F.col("source_record_id"))


def registrations(raw: DataFrame) -> DataFrame:
    rows, f = _items(raw)
    return rows.select(
        F.col("source_record_id").alias("registration_id"), f("buildingid").alias("building_id"), address.lot_from_parts(f("boro"), f("block"), f("lot")).alias("bbl"),
        blank_to_null(f("bin")).alias("bin"), address.borough(f("boro")).alias("borough"), local_timestamp(f("lastregistrationdate")).alias("last_registration_date"),
        local_timestamp(f("registrationenddate")).alias("registration_end_date"),
    )


def contacts(raw: DataFrame) -> DataFrame:
    rows, f = _items(raw)
    a = address.from_parts(f("businesshousenumber"), f("businessstreetname"), None, f("businesszip"))
    out = rows.select(
        F.col("source_record_id").alias("contact_id"), blank_to_null(f("registrationid")).alias("registration_id"), f("type").alias("contact_type"),
        names.name(f("corporationname")).alias("corporation_name"), names.person(f("firstname"), f("lastname")).alias("person_name"), a["normalized_address"].alias("mailing_address"),
        F.upper(blank_to_null(f("businesscity"))).alias("mailing_city"), F.upper(blank_to_null(f("businessstate"))).alias("mailing_state"), a["zipcode"].alias("mailing_zip"),
    )
    return out.withColumn("mailing_key", names.mailing_key(*[F.col(f"mailing_{k}") for k in ("address", "city", "state", "zip")]))


#: Clean table, its source and its builder.
BUILDERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "complaints": ("nyc_311", complaints),
    "permits": ("dob_permits", permits),
    "licenses": ("dca_licenses", licences),
    "pluto_lots": ("pluto", lots),
    "hpd_registrations": ("hpd_registrations", registrations),
    "hpd_contacts": ("hpd_contacts", contacts),
}


def address_rates(clean: DataFrame) -> DataFrame:
    return fill_rates(clean, pct_with_address="normalized_address", pct_with_bbl="bbl", pct_with_coords="latitude")
