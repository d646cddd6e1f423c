"""Seed rows of the dimensions and the display-name dictionaries, as plain fixed values."""

# Panel, menu order, theme, hierarchy, main audience, type.
PANELS = (
    ("Cotações Suínos - CEPEA", 1, "COTAÇÕES/PREÇOS", "Mercado e preços", "Produtores; Associações", "painel"),
    ("Cotações - Bolsas Estaduais", 2, "COTAÇÕES/PREÇOS", "Mercado e preços", "Produtores; Associações", "painel"),
    ("Cotações - Preços de Referência", 3, "COTAÇÕES/PREÇOS", "Mercado e preços", "Produtores; Agroindústrias", "painel"),
    ("Cotações - Insumos", 4, "COTAÇÕES/PREÇOS", "Mercado e preços", "Produtores; Agroindústrias", "painel"),
    ("Custos de Produção", 5, "CUSTOS DE PRODUÇÃO", "Produção", "Produtores; Associações", "painel"),
    ("Comércio Exterior", 6, "COMÉRCIO EXTERIOR", "Comércio Exterior", "Agroindústrias; Associações; Empresas", "painel"),
    ("IBGE Abate", 7, "ABATES", "Produção", "Associações; Frigoríficos; Empresas", "painel"),
    ("SIF Abate", 8, "ABATES", "Produção", "Frigoríficos; Associações", "painel"),
    ("Emprego - Perfil", 9, "EMPREGO", "Economia e financiamento", "Associações; Empresas", "painel"),
    ("Emprego - Movimentação", 10, "EMPREGO", "Economia e financiamento", "Associações; Empresas", "painel"),
    ("Crédito Rural - Suinocultura", 11, "CRÉDITO RURAL", "Economia e financiamento", "Produtores; Associações; Instituições financeiras", "painel"),
    ("Crédito Rural - Programas e Recursos", 12, "CRÉDITO RURAL", "Economia e financiamento", "Produtores; Associações; Instituições financeiras", "painel"),
    ("SIF Estabelecimentos", 13, "SEGURANÇA SANITÁRIA (SIF)", "Segurança sanitária", "Frigoríficos; Associações", "painel"),
    ("Cenário Empresarial", 14, "CENÁRIO EMPRESARIAL", "Estrutura da cadeia", "Empresas; Associações", "painel"),
    ("Cenário Empresarial - Cadastros", 15, "CENÁRIO EMPRESARIAL", "Estrutura da cadeia", "Empresas; Associações", "painel"),
    ("Cenário Empresarial - Evolução", 16, "CENÁRIO EMPRESARIAL", "Estrutura da cadeia", "Empresas; Associações", "painel"),
    ("Matrizes Tecnificadas - Modelo de Produção", 17, "MODELOS DE PRODUÇÃO", "Produção", "Associações; Agroindústrias; Produtores", "painel"),
    ("Competitividade Carne Suína", None, "COTAÇÕES/PREÇOS", "Mercado e preços", None, "painel"),
    ("Mercado Global", None, "COMÉRCIO EXTERIOR", "Comércio Exterior", None, "painel"),
    ("Tutorial", None, "(navegação)", "(navegação)", None, "auxiliar"),
)

# Spelling as delivered, canonical panel.
ALIASES = (
    ("Cotações Suínos CEPEA", "Cotações Suínos - CEPEA"),
    ("Cotações Insumos", "Cotações - Insumos"),
    ("Perfil", "Emprego - Perfil"),
    ("Movimentação", "Emprego - Movimentação"),
    ("Cotações Bolsas Estaduais", "Cotações - Bolsas Estaduais"),
    ("Preços de Referência", "Cotações - Preços de Referência"),
    ("Matrizes Tecnificadas Modelo de Produção", "Matrizes Tecnificadas - Modelo de Produção"),
    ("Estabelecimentos SIF", "SIF Estabelecimentos"),
    ("Cenário Empresarial Cadastros", "Cenário Empresarial - Cadastros"),
    ("Crédito Rural Suinocultura", "Crédito Rural - Suinocultura"),
    ("Comércio Exterior Importações", "Comércio Exterior"),
    ("Comércio Exterior - Exportações", "Comércio Exterior"),
    ("Comércio Exterior - Importações", "Comércio Exterior"),
    ("Suinocultura", "Crédito Rural - Suinocultura"),
    ("Programas e Recursos", "Crédito Rural - Programas e Recursos"),
    ("Precios de los cerdos CEPEA", "Cotações Suínos - CEPEA"),
    ("Precios del cerdo - CEPEA", "Cotações Suínos - CEPEA"),
    ("Cotizaciones - Bolsas de Valores Estatales", "Cotações - Bolsas Estaduais"),
    ("Cotizaciones - Precios de referencia", "Cotações - Preços de Referência"),
    ("Precios de referencia", "Cotações - Preços de Referência"),
    ("Cotizaciones - Suministros", "Cotações - Insumos"),
    ("Cotizaciones de entrada", "Cotações - Insumos"),
    ("Costos de producción", "Custos de Produção"),
    ("Matrices tecnificadas - Modelo de producción", "Matrizes Tecnificadas - Modelo de Produção"),
    ("Évolution du paysage commercial", "Cenário Empresarial - Evolução"),
    ("猪肉竞争力", "Competitividade Carne Suína"),
)

# URL target, panel, version of the report, origin of the assignment.
REPORT_IDS = (
    ("0cf2dce7-1107-4ff6-bbba-d208ffd06164", "Cotações - Preços de Referência", "desktop", "gtm"),
    ("871623e5-fc9c-45c5-999d-c22f9c4627be", "Cotações - Preços de Referência", "mobile", "gtm"),
    ("145d4c18-1710-4735-b2bc-616b2d3dd750", "Custos de Produção", "desktop", "gtm"),
    ("7cb43ec0-0d90-428b-ad77-5886280959cf", "Custos de Produção", "mobile", "gtm"),
    ("1f0d25a6-7063-4aef-b5d0-d4e333b4eebf", "SIF Estabelecimentos", "unica", "gtm"),
    ("2838d21b-86ed-4dd0-ac41-8b79c2c475cd", "Competitividade Carne Suína", "desktop", "gtm"),
    ("cf338aaf-14bd-489b-9a41-807afe77dec4", "Competitividade Carne Suína", "mobile", "gtm"),
    ("2c89d796-b651-4b78-b3f7-ac184785ca0d", "Cotações Suínos - CEPEA", "desktop", "gtm"),
    ("f18fbc07-cbb3-453f-a188-eacbb3a0a4e2", "Cotações Suínos - CEPEA", "mobile", "gtm"),
    ("2ecb122b-025d-4d1b-b1fd-af109ea5fdc9", "Crédito Rural - Suinocultura", "unica", "gtm"),
    ("faac1797-ff36-4ae8-8959-ba91f5a3cae2", "Crédito Rural - Programas e Recursos", "unica", "gtm"),
    ("2f84f0dd-a039-46d1-80ba-471808188eb6", "Comércio Exterior", "desktop", "gtm"),
    ("5d638192-523c-420b-b75b-d18f527d5c3b", "Comércio Exterior", "mobile", "gtm"),
    ("69389e53-1b6b-4a7c-adfa-6d3c2d9e2a37", "Comércio Exterior", "desktop", "gtm"),
    ("78f71132-05b0-4fdb-a10e-d66bb6ed846b", "Comércio Exterior", "mobile", "gtm"),
    ("3add12d1-6d15-4962-b98e-ade1cedb2173", "Cotações - Bolsas Estaduais", "desktop", "gtm"),
    ("fd60c386-8cb3-49d6-aedd-2c3113b5418d", "Cotações - Bolsas Estaduais", "mobile", "gtm"),
    ("4c8f9c2b-5486-4958-aaf6-be078c04e1ef", "Cotações - Insumos", "mobile", "gtm"),
    ("dfa7b2e5-1ba3-40e6-9996-af185f25e177", "Cotações - Insumos", "desktop", "gtm"),
    ("5066e261-8cf5-417d-8775-046859345346", "Emprego - Movimentação", "unica", "gtm"),
    ("f0795c90-fba6-4080-8350-abb760cbd705", "Emprego - Perfil", "unica", "gtm"),
    ("6c313865-260d-4de0-8bba-1bde3db28edd", "SIF Abate", "mobile", "gtm"),
    ("77672457-5993-4a09-8b2a-bebb9cb00366", "SIF Abate", "desktop", "gtm"),
    ("d30aa021-ecc9-4c7f-a112-273f5e2d65fd", "SIF Abate", "desktop", "gtm"),
    ("6fa6b559-3653-40ca-9e23-4cb95b9dee3f", "Matrizes Tecnificadas - Modelo de Produção", "desktop", "gtm"),
    ("c72ac6fa-6c6b-44d0-8bcf-7d8466ee934d", "Matrizes Tecnificadas - Modelo de Produção", "mobile", "gtm"),
    ("8350cc37-cbf9-4df6-a5c1-29e1a7af6de5", "Mercado Global", "mobile", "gtm"),
    ("cc158b2c-6a96-42c9-8f0b-09784843061f", "Mercado Global", "desktop", "gtm"),
    ("8e05cb85-77a1-40cb-8d64-8fcb7639d073", "IBGE Abate", "desktop", "gtm"),
    ("e6d56813-3137-4e6b-8bf6-c2d06a15147a", "IBGE Abate", "mobile", "gtm"),
    ("9217bafb-0786-43f4-b88a-9e8afcfaa75d", "Cenário Empresarial", "unica", "gtm"),
    ("eb236fce-ab93-40cc-839c-2eb2584e51a2", "Cenário Empresarial - Evolução", "unica", "gtm"),
    ("f1aa9f76-a584-4b28-86ba-b4fab1ac615e", "Cenário Empresarial - Cadastros", "unica", "gtm"),
    ("054f7949-07fb-4566-abca-df548e12540b", "Matrizes Tecnificadas - Modelo de Produção", "unica", "inferido"),
    ("1e89e34d-055c-43a9-a5d9-66c26c063260", "Cotações Suínos - CEPEA", "unica", "inferido"),
    ("54c124d3-39b5-4de7-8209-0415c9ba4549", "Cotações - Bolsas Estaduais", "unica", "inferido"),
    ("554daf31-bf45-4bb3-93dd-1ca51786290d", "Cotações - Preços de Referência", "unica", "inferido"),
    ("75c060af-a754-4bfe-a9f6-17786a859b20", "Cotações - Insumos", "unica", "inferido"),
    ("7ee99348-3fec-4258-bb5c-8a544c8221b2", "Comércio Exterior", "unica", "inferido"),
    ("c437a0c3-639a-4434-8f16-ecc294e89388", "IBGE Abate", "unica", "inferido"),
    ("e73d8faa-52f1-423a-9992-5dc1f57095d6", "Custos de Produção", "unica", "inferido"),
    ("tutorial.php", "Tutorial", "unica", "site"),
)

# Region as delivered, state, state code, country.
REGIONS = (
    ("State of Sao Paulo", "São Paulo", "SP", "Brazil"),
    ("State of Minas Gerais", "Minas Gerais", "MG", "Brazil"),
    ("State of Parana", "Paraná", "PR", "Brazil"),
    ("State of Rio Grande do Sul", "Rio Grande do Sul", "RS", "Brazil"),
    ("State of Santa Catarina", "Santa Catarina", "SC", "Brazil"),
    ("State of Goias", "Goiás", "GO", "Brazil"),
    ("State of Bahia", "Bahia", "BA", "Brazil"),
    ("State of Mato Grosso", "Mato Grosso", "MT", "Brazil"),
    ("State of Mato Grosso do Sul", "Mato Grosso do Sul", "MS", "Brazil"),
    ("State of Rio de Janeiro", "Rio de Janeiro", "RJ", "Brazil"),
    ("State of Rondonia", "Rondônia", "RO", "Brazil"),
    ("State of Ceara", "Ceará", "CE", "Brazil"),
    ("Ceara", "Ceará", "CE", "Brazil"),
    ("State of Pernambuco", "Pernambuco", "PE", "Brazil"),
    ("State of Maranhao", "Maranhão", "MA", "Brazil"),
    ("State of Para", "Pará", "PA", "Brazil"),
    ("State of Paraiba", "Paraíba", "PB", "Brazil"),
    ("State of Espirito Santo", "Espírito Santo", "ES", "Brazil"),
    ("State of Alagoas", "Alagoas", "AL", "Brazil"),
    ("State of Piaui", "Piauí", "PI", "Brazil"),
    ("State of Rio Grande do Norte", "Rio Grande do Norte", "RN", "Brazil"),
    ("State of Tocantins", "Tocantins", "TO", "Brazil"),
    ("State of Sergipe", "Sergipe", "SE", "Brazil"),
    ("Federal District", "Distrito Federal", "DF", "Brazil"),
    ("State of Roraima", "Roraima", "RR", "Brazil"),
    ("State of Amapa", "Amapá", "AP", "Brazil"),
    ("State of Acre", "Acre", "AC", "Brazil"),
    ("State of Amazonas", "Amazonas", "AM", "Brazil"),
    ("(not set)", "", "", ""),
)

# Country display names.
COUNTRY_NAMES = {
    "Brazil": "Brasil",
    "United States": "Estados Unidos",
    "China": "China",
    "Japan": "Japão",
    "Colombia": "Colômbia",
    "United Kingdom": "Reino Unido",
    "Netherlands": "Holanda",
    "Argentina": "Argentina",
    "Portugal": "Portugal",
    "Germany": "Alemanha",
    "Spain": "Espanha",
    "France": "França",
    "Mexico": "México",
    "Chile": "Chile",
    "Canada": "Canadá",
    "Italy": "Itália",
    "Bolivia": "Bolívia",
    "Paraguay": "Paraguai",
    "Peru": "Peru",
    "Uruguay": "Uruguai",
    "Ireland": "Irlanda",
    "Vietnam": "Vietnã",
    "India": "Índia",
    "Australia": "Austrália",
    "Belgium": "Bélgica",
    "Switzerland": "Suíça",
    "Sweden": "Suécia",
    "Denmark": "Dinamarca",
    "Austria": "Áustria",
    "(not set)": "Não identificado",
}

# State display names, after the prefix is dropped.
STATE_NAMES = {
    "Sao Paulo": "São Paulo",
    "Federal District": "Distrito Federal",
    "Parana": "Paraná",
    "Goias": "Goiás",
    "Ceara": "Ceará",
    "Espirito Santo": "Espírito Santo",
    "Maranhao": "Maranhão",
    "Piaui": "Piauí",
    "Amapa": "Amapá",
    "Para": "Pará",
    "Rondonia": "Rondônia",
    "Amazonas": "Amazonas",
}

# Device display names.
DEVICE_NAMES = {
    "desktop": "Computador",
    "mobile": "Celular",
    "tablet": "Tablet",
    "smart tv": "Smart TV",
    "(not set)": "Outro",
}
