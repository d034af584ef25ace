"""Part of gazetta; see README.md."""
