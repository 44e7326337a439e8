"""Reseller-billing analytics on Spark: costs, margins, licences, invoices and statements as DataFrame plans."""
