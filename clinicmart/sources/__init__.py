"""Reading landed files and tables, and storing tiers."""
