"""Loads built from the operators: payment types, jobseeker, rental reports;
the page -> newest link -> gate plan; name-resolved entry points."""

from arealens.plans.jobseeker import load_jobseeker
from arealens.plans.payment_types import load_payment_types, load_payment_types_all, payment_layout
from arealens.plans.publications import pending_publications
from arealens.plans.rental import load_rental, load_rental_all, rental_header

__all__ = ["load_jobseeker", "load_payment_types", "load_payment_types_all", "payment_layout",
           "pending_publications", "load_rental", "load_rental_all", "rental_header"]
