"""Writers of tables and documents."""
