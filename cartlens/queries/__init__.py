"""Query registrations (imported by cartlens.catalog)."""
