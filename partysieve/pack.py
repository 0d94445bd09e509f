"""Constants of one rule set, kept apart from the rules that use them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RulePack:
    """Values that the rules compare with or write.

    The defaults are the production values. Product selections are column -> value
    mappings; all of them must match, and an empty mapping selects every product.
    Single documents and policies with a decided value are deployment data: they have no default and
    must be passed, if only as empty.
    """

    # --- fixed values: they must equal the source system's for the results to be right ---
    holder: str = "CONTRATANTE"
    insured: str = "ASEGURADO"
    beneficiary: str = "BENEFICIARIO"

    copy_by_name_product: str = "DesgTarjetasIndividual"
    copy_by_name_note: str = "REGISTRA ASEGURADO POR DESG_TARJ_INDIV"
    copy_by_code_product: Mapping[str, str] = field(default_factory=lambda: {
        "line_code": "6.0", "subline_code": "2.0", "product_code": "15.0"})
    copy_by_code_note: str = "REGISTRA ASEGURADO POR SOAT"
    holderless_product: str = "ProtBlindajeIndividualPlus"
    parent_holder_note: str = "REGISTRO DE CONTRATANTE PARA COLECTIVOS"

    sheet_source: str = "EXCEL"
    digital_source: str = "DIGITAL"
    activity_sources: tuple[str, ...] = ("AS400", "EXCEL")
    activity_property: int = 3706454
    provisional_product: Mapping[str, str] = field(default_factory=lambda: {
        "line_code": "4", "subline_code": "01", "product_code": "01"})

    national_type: str = "DNI"
    legacy_type: str = "LE"
    legal_type: str = "RUCJ"
    unknown_type: str = "-1"
    no_document: str = "0"
    loan_products: tuple[str, ...] = ("DESGRAVAMENTARJETAS", "DESGRAVAMENPERSONAL")

    national: str = "PERUANO"
    foreign: str = "EXTRANJERO"
    unknown_nationality: str = "DESCONOCIDA"

    capital_region: str = "LIMA"
    no_region: str = "NINGUNO"
    region_synonyms: Mapping[str, str] = field(default_factory=lambda: {
        "PROV. CONST. DEL CALLAO": "CALLAO"})
    region_placeholders: tuple[str, ...] = ("PERU", "VARIOS", "-", ".")
    beneficiary_only_product: Mapping[str, str] = field(default_factory=lambda: {
        "line_code": "3", "subline_code": "01", "product_code": "04"})
    capital_product: Mapping[str, str] = field(default_factory=lambda: {
        "line_code": "21.0", "subline_code": "1.0", "product_code": "66.0"})

    product_sources_full: tuple[str, ...] = ("ACSELE", "EXPSERV", "RVIADM", "ADMWR")
    product_sources_named: tuple[str, ...] = ("AS400", "DIGITAL")
    product_sources_short: tuple[str, ...] = ("EXCEL",)

    natural: str = "NATURAL"
    legal: str = "JURIDICO"
    natural_spelling: str = "PERSONA NATURAL"
    legal_spelling: str = "PERSONA JURIDICA"

    rating_high: str = "Alto"
    rating_low: str = "Bajo"
    exposure_limit: float = 1500
    regime_high: int = 3
    regime_raised: int = 2
    regime_base: int = 1
    raisable_regimes: tuple[int, ...] = (1, 2)
    regime_sources: tuple[str, ...] = (
        "ACSELE", "EXPSERV", "DIGITAL", "AS400", "ADMWR", "RVIADM")
    regime_sheet_products: tuple[str, ...] = ("VidaGrupoComplementario", "VidaLeyTTL")

    handoff_kind: str = "E"
    handoff_events: tuple[str, ...] = ("Emitir", "EmitirRapida", "EmitirPropuesta")
    # --- end of fixed values ---

    # Deployment data. `newest_region_policies=None` selects every sheet policy.
    doc_type_overrides: Mapping[str, str] = field(kw_only=True)
    region_overrides: Mapping[str, str] = field(kw_only=True)
    newest_region_policies: tuple[str, ...] | None = field(kw_only=True)

    # Off: a row's region id stays as it came. On: it is looked up by region name.
    lookup_region_id: bool = False
    # Off: rows without a document number are no examples in the regime rule R020. On: they are, as '-'.
    null_document_matches_dash: bool = False
