"""Writers: the table warehouse and the published share."""
