"""Reading and writing: item files, nested records, models, documents."""
