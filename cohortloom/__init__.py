"""Patient-cohort and clinical-rule analytics as PySpark DataFrame operators."""
