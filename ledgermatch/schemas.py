"""Schemas of the tables.  Nothing is inferred."""

from __future__ import annotations

MOVEMENTS = (
    "movement_id long, date date, doc_type string, doc_number string, account string, account_name string, third_id string, "
    "third_name string, concept string, centre string, cost_centre string, user_code string, source_doc string, centre_name string, "
    "debit decimal(19,4), credit decimal(19,4)"
)

INVOICES = (
    "xml_id long, nit string, invoice string, date date, total double, line_extension double, tax_exclusive double, tax_inclusive double, "
    "payable double, iva double, inc double, discount double, charge double, discount_flag string, charge_flag string, industry string, "
    "supplier_name string, item_1 string, notes string"
)

XML_LINES = (
    "ordinal int, line_id string, item_code string, supplier_code string, description string, quantity string, amount string, currency string"
)
XML_HEADER = (
    "path string, key string, root string, invoice string, issue_date string, supplier_nit string, supplier_name string, customer_nit string, "
    "customer_name string, currency string, line_count int, line_extension string, tax_exclusive string, tax_inclusive string, payable string, "
    "iva_total string, inc_total string, discount string, charge string, legacy_discount string, notes string"
)

LISTING = (
    "row int, document_type string, key string, number string, prefix string, issue_date string, received string, issuer_nit string, "
    "issuer_name string, receiver_nit string, receiver_name string, total string, state string, group string, original string"
)
