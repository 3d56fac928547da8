"""Composite jobs: bronze -> silver (J1), training (J2), scoring and logging (J3), and the SQL
forms of the analytics (A9)."""
