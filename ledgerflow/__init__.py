"""Billing-dispute data engine expressed as Spark DataFrame plans."""
