"""End-to-end plans: the contact export job, its SQL twins and plan checks."""
