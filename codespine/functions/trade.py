"""Landed-cost arithmetic and evidence statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16
#: Delivery terms that an estimate accepts.
INCOTERMS = ("EXW", "FCA", "FOB", "CFR", "CIF", "CPT", "CIP", "DAP", "DPU", "DDP", "OTHER")


def cents(value: Column) -> Column:
    """Half-up rounding of a double to cents."""
    return F.floor((value + EPSILON) * 100 + 0.5).cast("double") / 100


def customs_value(direct: Column, product: Column, freight: Column, insurance: Column, additions: Column) -> Column:
    """A declared value as it is, else the declared components (missing ones are zero); null unless positive."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    total = F.coalesce(direct, cents(product + zero(freight) + zero(insurance) + zero(additions)))
    return F.when(total > 0, total)


def import_estimate(value: Column, igi: Column, dta: Column, ieps: Column, iva: Column) -> dict[str, Column]:
    """Contributions on a customs value, rates in percent; VAT is on the value with the other contributions."""
    part = lambda base, rate: cents(base * F.coalesce(rate, F.lit(0.0)) / 100)
    first = {"igi": part(value, igi), "dta": part(value, dta), "ieps": part(value, ieps)}
    base = cents(value + first["igi"] + first["dta"] + first["ieps"])
    vat = part(base, iva)
    total = cents(first["igi"] + first["dta"] + first["ieps"] + vat)
    return {**first, "iva_base": base, "iva": vat, "total_contributions": total, "landed_cost": cents(value + total)}


def missing(evidence: dict[str, Column]) -> Column:
    """Labels of what an operation has no evidence for, in the order given."""
    listed = F.array(*[F.when(~F.coalesce(have, F.lit(False)), F.lit(label)) for label, have in evidence.items()])
    return F.filter(listed, lambda x: x.isNotNull())


def status(evidence: dict[str, Column], *, applies: Column) -> Column:
    """``not_applicable``, ``complete``, ``partial`` or ``missing``."""
    n = F.size(missing(evidence))
    return F.when(~F.coalesce(applies, F.lit(False)), "not_applicable").when(n == 0, "complete").when(n < len(evidence), "partial").otherwise("missing")


def displayed_rate(text: Column, kind: Column) -> Column:
    return F.coalesce(text, kind, F.lit("-"))


#: Hosts that an official reference may be on.
OFFICIAL_HOSTS = {"tmec": ("gob.mx", "www.gob.mx"), "rrna": ("snice.gob.mx", "www.snice.gob.mx")}
#: What each matrix asks for, in order.
TMEC_LABELS = (
    "Declaraciones de proveedor", "Lista de materiales", "Regla específica de origen", "Método VCR declarado", "Certificación de origen",
    "Referencia de declaraciones de proveedor", "Referencia de lista de materiales",
)
RRNA_LABELS = ("Fracción propuesta", "Referencia oficial específica", "Fecha de consulta declarada", "Medida o alcance revisado", "Revisión humana declarada")
PEDIMENTO_LABELS = (
    "Fracción arancelaria propuesta", "Régimen aduanero", "País de origen", "Valor en aduana declarado", "Factura o documento equivalente", "Evidencia de transporte",
    "Evidencia de origen", "Revisión documental de RRNA y programas aplicables", "Referencia oficial específica de RRNA revisada",
)


def declared(value: Column) -> Column:
    """Whether a text says anything."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def official_reference(url: Column, consulted_at: Column, note: Column, kind: str) -> Column:
    """Whether a reference is an https address on one of the kind's hosts, without port or user, with a day and a note."""
    clean = F.trim(url)
    host = F.lower(F.try_parse_url(clean, F.lit("HOST")))
    plain = (F.lower(F.try_parse_url(clean, F.lit("PROTOCOL"))) == "https") & F.try_parse_url(clean, F.lit("USERINFO")).isNull() & ~F.try_parse_url(clean, F.lit("AUTHORITY")).rlike(r":(?!443\z)\d+\z")
    return F.coalesce(plain & host.isin(*OFFICIAL_HOSTS[kind]) & F.trim(consulted_at).rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.lit(False)) & declared(note)


def tmec_orientation(code: Column, origin: Column, content: Column, required: Column, reference: Column, have: list[Column]) -> dict[str, Column]:
    """``status`` and ``missing`` of a claim of origin; ``have``: conditions in the order of ``TMEC_LABELS``.

    Without code and origin, or without an official reference (``reference``), evidence is required; then a content below what is required ends it; contents that
    are missing are zero. A claim without a reference lists nothing that is missing (null).
    """
    lacking = missing(dict(zip(TMEC_LABELS, have, strict=True)))
    known = declared(code) & declared(origin)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    of = F.when(~known | ~reference, "evidence_required").when(zero(content) < zero(required), "threshold_not_met").when(F.size(lacking) > 0, "evidence_required").otherwise("evidence_review_required")
    return {"status": of, "missing": F.when(~known | reference, lacking)}


def rrna_orientation(code: Column, reference: Column, consulted_at: Column, note: Column, reviewed: Column) -> dict[str, Column]:
    """``status`` and ``missing`` of what regulations ask for. A code of other than eight or ten digits is no code."""
    digits = F.regexp_replace(F.trim(code), r"[.\s-]", "")
    have = [F.coalesce(digits.rlike(r"\A\d{8}(?:\d{2})?\z"), F.lit(False)), reference, declared(consulted_at), declared(note), reviewed]
    lacking = missing(dict(zip(RRNA_LABELS, have, strict=True)))
    return {"status": F.when(F.size(lacking) > 0, "evidence_required").otherwise("evidence_review_required"), "missing": lacking}


def pedimento_checklist(code: Column, regime: Column, origin: Column, value: Column, invoice: Column, transport: Column, origin_evidence: Column, reviewed: Column, reference: Column) -> dict[str, Column]:
    """``status`` and ``missing`` of a customs declaration's checklist."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    have = [filled(code), filled(regime), filled(origin), F.coalesce((value > 0) & ~F.isnan(value) & (value != float("inf")), F.lit(False)), invoice, transport, origin_evidence, reviewed, reference]
    lacking = missing(dict(zip(PEDIMENTO_LABELS, have, strict=True)))
    return {"status": F.when(F.size(lacking) == 0, "review_required").otherwise("incomplete"), "missing": lacking}
